"""Lazy DataFrame-in, DataFrame-out operators."""
