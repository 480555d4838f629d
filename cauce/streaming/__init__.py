"""Incremental loading of the append-only tables."""
