"""Stateful request auditing as batch and Structured Streaming jobs."""
