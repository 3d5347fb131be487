"""kinweave: Spark-native record linkage, archive analytics and corpus preparation."""
