"""Readers, writers, table contracts and the binding of raw tables to canonical entities."""
