"""Readers and writers for the feeds, the key state and the corpus."""
