"""Sensor and frame stream analytics written against the PySpark DataFrame API."""

__version__ = "0.1.0"
