"""Spark-native analytics for daily activity series and entity snapshots."""
