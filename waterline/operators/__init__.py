"""Operators over snapshot facts, catalog feeds and the asset dimension."""
