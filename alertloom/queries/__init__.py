"""The operators applied to the given tables, each with its check in SQL."""
