"""salesmart.plans."""
