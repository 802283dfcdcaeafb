"""End-to-end jobs over files."""
