"""Workforce timekeeping analytics as PySpark DataFrame jobs."""
