"""Sources and sinks: typed CSV, Parquet table sets, ETL with an audit."""
