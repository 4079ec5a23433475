"""Structured Streaming jobs; each drains its backlog and stops."""
