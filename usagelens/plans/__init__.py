"""Whole jobs, each a function with a thin command line around it."""
