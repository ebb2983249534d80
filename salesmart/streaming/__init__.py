"""salesmart.streaming."""
