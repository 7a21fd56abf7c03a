"""Stateless operators on streams."""
