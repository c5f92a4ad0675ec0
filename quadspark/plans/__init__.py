"""Whole queries put together from operators, and the query catalogue."""
