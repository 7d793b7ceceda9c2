"""Operators with state that outlives a batch."""
