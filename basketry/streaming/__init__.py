"""Structured Streaming over landing folders (an extension: the batch operators don't need it)."""
