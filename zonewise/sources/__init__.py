"""Readers for files, documents and streams; every one returns a lazy DataFrame with an explicit schema."""
