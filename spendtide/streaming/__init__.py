"""Incremental pick-up of landed pages."""
