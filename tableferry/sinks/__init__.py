"""Writing: file tables, delimited text, catalog tables."""
