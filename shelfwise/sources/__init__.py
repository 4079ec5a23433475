"""Readers of tables, files and logs."""
