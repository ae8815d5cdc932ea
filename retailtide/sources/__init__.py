"""Readers: message topics, change feeds, databases, report tables."""
