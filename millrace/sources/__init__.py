"""Readers, table schemas and catalog helpers."""
