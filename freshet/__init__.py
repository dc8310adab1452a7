"""Composable Spark operators for event streams and tables."""
