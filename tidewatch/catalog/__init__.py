"""Named queries on the given tables, and the same queries in SQL."""
