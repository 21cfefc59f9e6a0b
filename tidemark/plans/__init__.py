"""Whole jobs: the checks, one ingestion run, the loop over all sources."""
