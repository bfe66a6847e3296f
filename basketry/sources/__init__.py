"""Where the seven relations come from: CSV extracts, stored Parquet, or the test tables."""
