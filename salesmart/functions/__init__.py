"""salesmart.functions."""
