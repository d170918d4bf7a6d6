"""Reading: files, catalog tables and relational databases."""
