"""Landed payloads and tables."""
