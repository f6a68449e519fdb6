"""Readers, writers and work lists."""
