"""Many requests at once, but never more than a bound, however many cores there are.

The bound is shared out among tasks: as many tasks as there are cores, or as the bound allows, each with so many threads.
So at most the bound is in flight over all executors, and a waiting request does not hold a core. A request that fails in
a way that may pass is made again after a pause that doubles each time.
"""

from __future__ import annotations

import time
import urllib.error
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.sql import DataFrame

#: Of HTTP's answers those that may be other ones the next time.
_PASSING = frozenset({408, 425, 429, 500, 502, 503, 504})


@dataclass(frozen=True)
class Limits:
    """``at_once`` requests in flight; ``attempts`` for each; ``pause`` seconds before the second one, at most ``longest``."""

    at_once: int = 16
    attempts: int = 3
    pause: float = 0.5
    longest: float = 30.0


def shared_out(df: DataFrame, limits: Limits) -> tuple[DataFrame, int]:
    """The rows dealt to as many tasks as may ask, and the requests that each of these may have in flight."""
    tasks = max(1, min(limits.at_once, df.sparkSession.sparkContext.defaultParallelism))
    return df.repartition(tasks), limits.at_once // tasks


def may_pass(error: Exception) -> bool:
    if isinstance(error, urllib.error.HTTPError):
        return error.code in _PASSING
    return isinstance(error, (urllib.error.URLError, TimeoutError, ConnectionError))


def _pause(error: Exception, attempt: int, limits: Limits) -> float:
    """The server's own word, if it gives seconds, else twice as long as before."""
    said = error.headers.get("Retry-After") if isinstance(error, urllib.error.HTTPError) and error.headers else None
    return min(limits.longest, float(said) if said and said.isdigit() else limits.pause * 2**attempt)


def patiently(ask: Callable[..., str], limits: Limits, *prompt: str) -> str:
    for attempt in range(limits.attempts):
        try:
            return ask(*prompt)
        except Exception as e:
            if attempt == limits.attempts - 1 or not may_pass(e):
                raise
            time.sleep(_pause(e, attempt, limits))
    raise ValueError("attempts must be 1 or more")


def answers(ask: Callable[..., str], prompts: Iterable[tuple[str, ...]], threads: int, limits: Limits) -> Iterator[tuple[str, Exception | None]]:
    """(answer, None), or ("", what was raised), for each prompt, in order. ``ask`` must bear to be called by several threads."""

    def one(prompt: tuple[str, ...]) -> tuple[str, Exception | None]:
        try:
            return patiently(ask, limits, *prompt), None
        except Exception as e:  # whatever the endpoint or the network raises is this request's result
            return "", e

    with ThreadPoolExecutor(max(1, threads)) as pool:
        yield from pool.map(one, prompts)


def all_answers(ask: Callable[..., str], prompts: Iterable[tuple[str, ...]], threads: int, limits: Limits) -> list[str]:
    """As ``answers``, but a request that fails raises."""
    out = []
    for answer, error in answers(ask, prompts, threads, limits):
        if error:
            raise error
        out.append(answer)
    return out
