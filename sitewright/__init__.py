"""Comparative-genomics analytics as composable Spark DataFrame jobs."""
