"""salesmart.sources."""
