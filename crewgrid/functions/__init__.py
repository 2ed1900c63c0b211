"""functions of the workforce engine."""
