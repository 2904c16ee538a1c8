"""Declared source tables."""
