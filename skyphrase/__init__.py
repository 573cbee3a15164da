"""A Spark-native engine for synthetic radio-dialogue and voice-reference datasets."""
