"""Readers of text formats and writers of tracks and documents."""
