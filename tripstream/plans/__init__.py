"""Composed plans: Silver/Gold layers and the registered query catalog."""
