"""Operators that prepare text corpora for training. Nothing outside this folder imports it."""
