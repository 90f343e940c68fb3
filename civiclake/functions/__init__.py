"""Column-level building blocks: casts, text, dates, geometry, JSON."""
