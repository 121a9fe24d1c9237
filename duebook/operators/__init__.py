"""Relational operators: lookups, roll-ups, aging, typing."""
