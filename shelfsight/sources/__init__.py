"""Readers, record mappings and writers."""
