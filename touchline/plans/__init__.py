"""The football warehouse: staging, marts and their declared checks."""
