"""periodload.sources."""
