"""quarrymark: Spark-first operators for curating web pages and their structured data."""
