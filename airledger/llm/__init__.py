"""Operators of a training-data pipeline: extraction, de-duplication, tokens, filters, layout."""
