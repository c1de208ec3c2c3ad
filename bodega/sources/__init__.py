"""Readers and writers: relational sources, files, lake tables."""
