"""Dataset specs, standardization, features, marts and the refresh of one dataset."""
