"""Compositions of operators into whole queries, each next to the SQL that checks it."""
