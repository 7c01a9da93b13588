"""Runs that chain operators, and the queries the driver checks."""
