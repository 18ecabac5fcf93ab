"""periodload.plans."""
