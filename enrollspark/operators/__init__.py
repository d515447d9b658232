"""Relational operators of the extract: spans, providers, records, change runs, optional operators."""
