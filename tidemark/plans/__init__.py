"""Dimensions, facts and reports composed from the operators."""
