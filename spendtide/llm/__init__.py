"""Operators for preparing text corpora at scale; nothing else here imports them."""
