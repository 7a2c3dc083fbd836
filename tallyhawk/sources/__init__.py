"""Readers and file metadata."""
