"""Typed, dated output and its display form."""
