"""Typed reads and table writes."""
