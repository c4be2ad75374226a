"""Derived tables, each a function of the tables it is built from."""
