"""Whole jobs built from the operators, and the catalog of checked queries."""
