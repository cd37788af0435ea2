"""Whole jobs made of operators, and the catalogue of registered queries."""
