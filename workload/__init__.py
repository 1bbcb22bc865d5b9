"""The named queries: the library's operators bound to the given tables."""
