"""Structured Streaming: state kept by key."""
