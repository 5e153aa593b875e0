"""Product-growth analytics as PySpark DataFrame operators."""
