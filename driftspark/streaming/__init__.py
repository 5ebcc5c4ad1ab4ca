"""Continuous change detection."""
