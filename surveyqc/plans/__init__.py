"""Operators chained to whole runs."""
