"""Whole jobs: the declared checks, the mart build and its release gate, and the query catalogue."""
