"""Whole dataflows composed from the operators, and the registered queries."""
