"""Incremental landing and alerts on streams."""
