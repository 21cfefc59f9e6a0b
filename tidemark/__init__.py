"""Tidemark: metadata-driven incremental ingestion as plain PySpark.

A registry says which tables and files to load, a high-water mark per source
says how far each has been read, a run journal records every attempt, and a set
of checks shows that a mark moves only when a run succeeds.
"""
