"""Spark-native analytics engine for detections in image sequences."""
