"""Whole jobs and the registry of checked queries."""
