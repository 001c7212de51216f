"""Readers, writers and the feature contract."""
