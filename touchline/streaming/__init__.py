"""Structured Streaming versions of the workflow steps."""
