"""Readers: text lines, topics, record parsing, reference tables."""
