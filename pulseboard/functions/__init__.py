"""Column helpers. Every helper takes and returns Spark Columns, no Python UDF."""
