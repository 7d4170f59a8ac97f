"""Streams into the incremental merges."""
