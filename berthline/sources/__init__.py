"""Readers and writers: CSV uploads, record JSON, request bodies, output paths."""
