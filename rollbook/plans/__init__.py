"""Whole jobs: the load, the searches, and the queries registered for checks."""
