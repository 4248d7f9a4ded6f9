"""Operators on streams of events."""
