"""Operators for building training text at scale, and their registered queries."""
