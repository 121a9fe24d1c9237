"""The checked queries: library operators over the given tables, each with its SQL counterpart."""
