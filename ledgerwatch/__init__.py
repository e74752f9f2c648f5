"""Fraud and risk analytics expressed as Spark DataFrame jobs."""
