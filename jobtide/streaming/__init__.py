"""Structured Streaming front ends for the two incremental steps."""
