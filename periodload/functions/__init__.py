"""periodload.functions."""
