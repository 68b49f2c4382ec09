"""Where tables come from: parquet folders, JDBC sources, and the test stand-in."""
