"""Readers, writers and the parsing of raw product documents."""
