"""Scans, sinks and the derivation of historian tables from the event data."""
