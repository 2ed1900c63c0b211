"""streaming of the workforce engine."""
