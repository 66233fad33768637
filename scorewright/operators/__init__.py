"""scorewright.operators."""
