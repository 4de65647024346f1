"""Incremental twins of the batch operators."""
