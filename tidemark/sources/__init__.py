"""Readers for tables and landing files, and the writers next to them."""
