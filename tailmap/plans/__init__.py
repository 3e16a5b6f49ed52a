"""Protocols, whole pipelines, and views of other tables as reads, sites and features."""
