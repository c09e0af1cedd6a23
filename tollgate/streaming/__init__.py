"""Structured Streaming runners for the two hops."""
