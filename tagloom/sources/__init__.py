"""Readers: period snapshots, the rule catalog, relational tables."""
