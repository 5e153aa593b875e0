"""Event vocabulary, table schemas, and reading and writing of tables."""
