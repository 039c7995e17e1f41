"""Readers and writers: files, message streams and the keyed archive."""
