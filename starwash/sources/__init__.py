"""Reading and writing: CSV, staged files, catalog tables."""
