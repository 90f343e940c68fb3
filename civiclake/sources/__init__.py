"""Reading landed files and catalog tables; writing layer tables."""
