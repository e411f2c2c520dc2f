"""Composite queries made of several operators."""
