"""Column functions: safe casts, keys, bands and review text."""
