"""Refreshing from a landing folder as files arrive."""
