"""Append-only histories fed by Structured Streaming."""
