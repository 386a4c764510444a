"""Longitudinal process metrics of software projects as Spark DataFrame jobs."""
