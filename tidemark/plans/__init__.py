"""Reusable plan shapes: chunked running aggregates and greedy windows."""
