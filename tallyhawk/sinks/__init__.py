"""Writers: partitioned Parquet, CSV, JDBC and catalog tables."""
