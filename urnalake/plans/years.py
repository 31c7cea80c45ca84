"""Several years' jobs at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor

PARALLEL_YEARS = 4


def run_years(job: Callable[[int], object], years: Iterable[int], parallel: int = PARALLEL_YEARS) -> None:
    """Submit the yearly jobs from a few threads, so one year's last tasks overlap the next's first.

    A failing year does not stop the others; each logs its own outcome, and the first
    failure is raised at the end.
    """
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        futures = [pool.submit(job, year) for year in years]
    for future in futures:
        future.result()
