"""scorewright.streaming."""
