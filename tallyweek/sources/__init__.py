"""Inputs: landed files with fixed schemas, scoring weights, and tables derived for checking."""
