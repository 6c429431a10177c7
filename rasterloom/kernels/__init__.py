"""Sequential algorithms on one tile, in NumPy; they run in parallel over tiles."""
