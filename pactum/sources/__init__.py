"""Readers, writers and the mapping of generic test tables onto the domain."""
