"""The analytics tables derived from the benchmark tables, for Spark and SQL."""
