"""Whole conversions composed from the operators."""
