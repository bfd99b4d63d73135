"""The registered queries: inputs derived from the given tables, and SQL to check against."""
