"""Relational operators: each takes a Site (or frames) and returns a lazy DataFrame."""
