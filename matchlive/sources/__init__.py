"""Readers for event logs, match files and tables."""
