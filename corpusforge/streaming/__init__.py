"""Structured Streaming jobs: the run guard and scoring of a stream."""
