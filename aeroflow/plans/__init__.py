"""Whole queries: one function per dashboard panel, and the table build."""
