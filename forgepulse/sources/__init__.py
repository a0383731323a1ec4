"""Readers of raw events and audits of what has landed."""
