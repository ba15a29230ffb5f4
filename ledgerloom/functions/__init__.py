"""Column functions: cleaning, keys, code maps."""
