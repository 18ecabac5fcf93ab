"""periodload.streaming."""
