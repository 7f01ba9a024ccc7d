"""Part of Quarry."""
