"""Raw feeds and dimensions, read from files or derived from the driver's tables."""
