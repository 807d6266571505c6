"""Reusable PySpark operators for file landing, period-to-date KPIs, data
quality, dialogue statistics and regression work."""
