"""Streaming queries, their sinks, and the pipeline that ties them together."""
