"""Operators over registries, journals and watermarked sources."""
