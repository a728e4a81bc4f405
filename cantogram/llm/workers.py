"""What a Python worker keeps between tasks. Functions travel by value, so nothing here needs the package on the executors."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.broadcast import Broadcast


def kept_with(held: Broadcast, build: Callable, *args):
    """What ``build`` makes of a broadcast value, made once per worker: a worker keeps its broadcasts from task to task."""
    made = held.__dict__.setdefault("_made", {})
    if args not in made:
        made[args] = build(held.value, *args)
    return made[args]
