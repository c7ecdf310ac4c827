"""Reusable column and window building blocks."""
