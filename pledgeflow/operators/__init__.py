"""Relational operators: merge, reconcile, aggregate, rank, interpolate."""
