"""Operators for large text corpora used to train language models."""
