"""Whole reports: documents, star tables and the registry of queries."""
