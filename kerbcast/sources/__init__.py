"""Readers and writers for landed files and result tables."""
