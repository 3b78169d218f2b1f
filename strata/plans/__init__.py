"""Table builders, flows, quality checks and the registered queries."""
