"""Column-level rules: standardization, bucketing, derivation."""
