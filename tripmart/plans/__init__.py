"""Assembled jobs: the full report, the trip view, and the query registry."""
