"""Workflow steps built from the operators."""
