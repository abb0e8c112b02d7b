"""Readers that normalise sources to the article schema."""
