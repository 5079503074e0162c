"""Structured Streaming jobs: the batch operators under a watermark."""
