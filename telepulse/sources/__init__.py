"""Readers, writers and the adapters from the generic events table."""
