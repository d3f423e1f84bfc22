"""A Spark-native analytics engine for listed-company fundamentals."""
