"""Profiles of raw tables and the reports drawn from the facts."""
