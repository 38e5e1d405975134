"""Structured Streaming jobs: keyed, idempotent writes, so that redelivery changes nothing."""
