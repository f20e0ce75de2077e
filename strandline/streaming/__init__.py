"""Structured Streaming: file sources, claims and validation in micro-batches, heartbeats and the blocked state."""
