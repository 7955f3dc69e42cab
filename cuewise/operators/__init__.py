"""Operators over segments, turns and chunks; every one is keyed by recording."""
