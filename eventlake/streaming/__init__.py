"""Sinks, lake tables and the running pipelines."""
