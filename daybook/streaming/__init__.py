"""Structured Streaming jobs: contract split, landing with dedup, speed layer."""
