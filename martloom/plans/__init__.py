"""Marts put together from the operators."""
