"""Readers for HTML tables, JSON feeds and CSV; writers for the layers and exports."""
