"""tickloom: Spark-native bar analytics (see README)."""
