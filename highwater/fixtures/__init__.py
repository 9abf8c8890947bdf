"""Inputs of the registered queries, derived from the test tables, and their oracle SQL."""
