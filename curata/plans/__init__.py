"""Composed plans: the shared pipeline artifacts, the query registry and
its SQL oracles."""
