"""Readers, writers and model folders."""
