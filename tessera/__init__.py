"""tessera: a Spark-native record-linkage and analytics engine."""
