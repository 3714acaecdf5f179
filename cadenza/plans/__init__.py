"""Fixtures, registered queries and SQL oracles."""
