"""Operators and the pipeline for large text corpora.  Nothing else in the package imports this folder."""
