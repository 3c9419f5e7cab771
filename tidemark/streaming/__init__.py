"""Structured Streaming jobs; they call the same operators as the batch jobs."""
