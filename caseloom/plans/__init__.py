"""Compositions of the operators into whole jobs."""
