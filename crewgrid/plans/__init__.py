"""plans of the workforce engine."""
