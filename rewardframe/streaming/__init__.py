"""Structured Streaming forms (X01-X06): the same column functions on
``readStream`` input, watermarks, session windows and per-run state."""
