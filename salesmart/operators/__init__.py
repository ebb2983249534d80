"""salesmart.operators."""
