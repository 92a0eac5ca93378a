"""Registered queries over the domain views, each with its check in plain SQL."""
