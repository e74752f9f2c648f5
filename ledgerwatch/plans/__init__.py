"""Declarative reports over the audit table, and the training and scoring jobs."""
