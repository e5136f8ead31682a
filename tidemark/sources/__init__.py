"""Scans: raw events, raw JSON lines, tables, text pages, dimensions."""
