"""Builds (dims, fact, bridges), reports, quality checks, refresh, and the query registry."""
