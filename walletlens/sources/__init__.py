"""Extracts, readers and writers."""
