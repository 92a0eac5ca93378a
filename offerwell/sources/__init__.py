"""Readers, writers and the domain views over stored tables."""
