"""periodload.operators."""
