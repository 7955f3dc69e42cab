"""Rendered documents and the query catalogue."""
