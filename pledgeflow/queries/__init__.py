"""Queries bound to the benchmark tables, each next to its SQL oracle."""

from pledgeflow.queries import registry


def load_all() -> None:
    """Import every module that registers queries."""
    from pledgeflow.queries import (  # noqa: F401
        aggregates,
        curves,
        documents,
        files,
        joins,
        merges,
        pages,
        reports,
        scalars,
        streams,
    )


def all_queries():
    load_all()
    return dict(registry.QUERIES)


def all_oracles():
    load_all()
    return dict(registry.ORACLES)
