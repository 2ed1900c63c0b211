"""sources of the workforce engine."""
