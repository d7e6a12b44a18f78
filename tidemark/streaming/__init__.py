"""Structured Streaming: windowed figures, scoring, replay, reconciliation."""
