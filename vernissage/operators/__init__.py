"""Relational operators over crawled snapshots."""
