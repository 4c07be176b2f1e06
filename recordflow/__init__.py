"""Record ingestion and keyed-table maintenance on PySpark DataFrames."""
