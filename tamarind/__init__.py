"""A Spark-first engine for procurement-style records and their documents."""
