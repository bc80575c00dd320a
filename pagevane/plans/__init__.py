"""Whole jobs: the stages as batch steps, and the registered queries."""
