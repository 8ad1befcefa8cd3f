"""Reusable DataFrame steps shared by the plans."""
