"""A Spark-native engine for bar features and corpus preparation."""
