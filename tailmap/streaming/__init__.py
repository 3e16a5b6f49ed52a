"""Incremental processing of files as they arrive."""
