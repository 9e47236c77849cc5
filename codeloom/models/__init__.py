"""Classifiers and their selection."""
