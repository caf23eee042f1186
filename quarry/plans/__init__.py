"""Named-query catalogues: one module per reference project on its original
schema, plus ``testdata`` (the same queries on the supplied test tables) and
``testdata_sql`` (independent SQL for the driver's DuckDB check)."""
