"""Reading raw files and writing tables."""
