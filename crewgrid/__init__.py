"""Workforce analytics as lazy Spark plans."""
