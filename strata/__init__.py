"""strata: layered-warehouse operators for PySpark.

Bronze ingestion with lineage, conformed dimensions (rule-based
standardization, mini-dimensions, hash and distributed sequential surrogate
keys), a typed base fact table, schema-keeping table writes and data-quality
checks that return DataFrames.  Everything is a ``DataFrame -> DataFrame``
function over Spark SQL built-ins.
"""

__version__ = "0.1.0"
