"""Readers, writers and the registry of named tables."""
