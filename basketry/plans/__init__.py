"""End-to-end jobs: read tables, compose operators, write tables."""
