"""Relational operators: version stores, history, spatial joins, quality, exploration."""
