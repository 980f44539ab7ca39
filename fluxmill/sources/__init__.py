"""Readers, writers, table mappings and seeded generators."""
