"""Structured Streaming forms of the hourly landing."""
