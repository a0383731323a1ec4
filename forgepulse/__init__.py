"""Batch analytics over code-hosting activity events, written for Spark."""
