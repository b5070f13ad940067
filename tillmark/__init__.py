"""Statistical operators for retail sales tables, written as Spark DataFrame programs."""
