"""Operators for text corpora: filtering, deduplication, counting, packing, archives and search."""
