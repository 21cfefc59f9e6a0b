"""The registered queries: Tidemark over the given tables, with SQL twins."""
