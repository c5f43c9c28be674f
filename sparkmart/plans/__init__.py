"""Composite plans: models, data checks, tagging and report tables."""
