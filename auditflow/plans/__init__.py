"""Compositions of operators that a user calls as one job."""
