"""Subscriber-activity analytics as PySpark DataFrame operators and jobs."""
