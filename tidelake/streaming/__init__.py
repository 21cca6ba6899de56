"""Incremental runs: Structured Streaming with an available-now trigger by default."""
