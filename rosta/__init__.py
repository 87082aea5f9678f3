"""rosta: a Spark-native engine for captured boards, question pages and classified ads."""
