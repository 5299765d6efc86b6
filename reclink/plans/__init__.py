"""Whole steps, composed of operators."""
