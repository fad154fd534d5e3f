"""Registered queries: every operator and flow over workforce frames derived from the given tables."""
