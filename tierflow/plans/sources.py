"""Run a step for several sources side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

from tierflow.specs import SOURCES, SourceSpec

# Sources have very different sizes; together they keep the cluster busy.
SIDE_BY_SIDE = 4


def each_source(
    step: Callable[[SourceSpec], object], specs: Iterable[SourceSpec] = SOURCES
) -> None:
    """Submit ``step(spec)`` for each source, a few at a time; the first failure is raised."""
    with ThreadPoolExecutor(SIDE_BY_SIDE) as pool:
        for _ in pool.map(step, specs):
            pass
