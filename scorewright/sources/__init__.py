"""scorewright.sources."""
