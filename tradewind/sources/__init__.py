"""Readers, writers and declared schemas."""
