"""Writers: partitioned Parquet appends and delimited exports."""
