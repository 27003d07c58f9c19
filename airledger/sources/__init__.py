"""Inputs: change feeds (topic or files) and base tables."""
