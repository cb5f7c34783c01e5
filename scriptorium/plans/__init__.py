"""Whole runs, and the registered queries with their SQL."""
