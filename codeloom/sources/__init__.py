"""Readers, sinks, model bundles and the embedding cache."""
