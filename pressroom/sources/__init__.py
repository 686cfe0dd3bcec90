"""Readers and writers, and the shaping of raw feed, search and message bodies."""
