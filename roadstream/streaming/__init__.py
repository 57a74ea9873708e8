"""Structured Streaming: query runners and stateful operators."""
