"""Incident analytics and anomaly scoring on PySpark."""
