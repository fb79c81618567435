"""Every operator bound to the test tables."""

from tidewright.plans import (  # noqa: F401
    ends,
    eventtimes,
    placements,
    registry,
    rollings,
    rows,
    states,
    user_functions,
    windowed,
    wordcounts,
)


def all_queries():
    return dict(registry.QUERIES)


def all_oracles():
    return dict(registry.ORACLES)
