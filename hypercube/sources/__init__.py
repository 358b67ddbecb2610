"""Readers, writers and test-input fixtures."""
