"""operators of the workforce engine."""
