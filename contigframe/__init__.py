"""Genome-annotation analytics as composable PySpark DataFrame operators."""
