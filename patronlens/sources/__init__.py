"""Typed tables in, keyed tables out."""
