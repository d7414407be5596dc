"""Spark-native supply-chain analytics, with operators for training-data pipelines."""
