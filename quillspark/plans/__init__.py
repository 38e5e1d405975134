"""Whole jobs built from the operators, and the views and queries over the given tables."""
