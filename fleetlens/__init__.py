"""Sensor-fleet analytics as Spark DataFrame operators."""
