"""Incremental runs over a file stream and live tracking of jobs."""
