"""A Spark-native record-linkage and candidate-retrieval engine."""
