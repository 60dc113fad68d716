"""Incremental runs of the same operators."""
