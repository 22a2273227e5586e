"""Structured Streaming forms of the incremental operators (V1-V4)."""
