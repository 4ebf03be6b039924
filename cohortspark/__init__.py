"""Cohort-imaging analytics as Spark DataFrame operators."""
