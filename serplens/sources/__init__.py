"""Readers and writers: the only modules that touch files."""
