"""Sensor change-stream analytics on Spark: decode, windows, alerts, latest status, trends."""
