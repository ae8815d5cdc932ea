"""Structured Streaming wiring of the reports."""
