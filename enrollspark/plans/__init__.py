"""Whole-job plans (extract, sort, sink, change publication) and the named query registry."""
