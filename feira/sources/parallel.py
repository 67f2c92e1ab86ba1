"""Submitting independent Spark jobs side by side."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from typing import TypeVar

T = TypeVar("T")

# Enough that small tables do not leave a cluster idle while one job waits for its last tasks.
JOBS = 4


def run_all(jobs: Iterable[Callable[[], T]]) -> list[T]:
    """The results in the order of `jobs`; the first error is raised after all have ended.

    The jobs see the context of the caller, such as the scratch folder of its run.
    """
    with ThreadPoolExecutor(JOBS) as pool:
        running = [pool.submit(copy_context().run, job) for job in jobs]
    return [job.result() for job in running]
