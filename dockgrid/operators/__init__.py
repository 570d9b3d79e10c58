"""Operators."""
