"""Operators for preparing text corpora: packing, token counts, scans, dedup."""
