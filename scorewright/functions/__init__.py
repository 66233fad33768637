"""scorewright.functions."""
