"""Readers, writers and import stages."""
