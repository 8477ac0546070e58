"""Spark-native operators over software-repository evidence."""
