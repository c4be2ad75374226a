"""Checks return the rows that fail; no rows means the check passes."""
