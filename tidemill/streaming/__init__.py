"""Structured Streaming form of the signal-window features."""
