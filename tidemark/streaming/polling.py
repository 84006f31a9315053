"""The poll loop: prepare, process, sleep with jitter, until told to stop; pipelines side by side, failures apart."""

from __future__ import annotations

import logging
import random
import signal
import threading
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextlib import nullcontext

log = logging.getLogger(__name__)


class Stop:
    """Told once, from a signal or another thread."""

    def __init__(self) -> None:
        self.event = threading.Event()

    def on_signals(self) -> Stop:
        for s in (signal.SIGINT, signal.SIGTERM, signal.SIGQUIT):
            signal.signal(s, lambda *_: self.event.set())
        return self

    def set(self) -> None:
        self.event.set()

    def wait(self, seconds: float) -> bool:
        return self.event.wait(seconds)

    @property
    def told(self) -> bool:
        return self.event.is_set()


def poll(step: Callable[[], int], interval: float, jitter: float = 0.0, stop: Stop | None = None, once: bool = False, finish: Callable[[], None] | None = None, rng: random.Random | None = None) -> int:
    """Runs step again and again and returns what its results add up to. A step that has begun ends before a stop counts, so
    nothing is saved that isn't done. The first step waits up to `jitter` seconds, and so does each sleep."""
    stop, rng, total = stop or Stop(), rng or random.Random(), 0
    try:
        if jitter and not once and stop.wait(rng.uniform(0, jitter)):
            return total
        while not stop.told:
            total += step()
            if once or stop.wait(interval + (rng.uniform(0, jitter) if jitter else 0)):
                break
        return total
    finally:
        if finish:
            finish()


def run_side_by_side(runs: dict[str, Callable[[], int]], concurrency: int | None = None) -> dict[str, int | Exception]:
    """Each run in a thread of its own, `concurrency` at work at a time; one that fails is logged and the others go on."""
    gate = threading.Semaphore(concurrency) if concurrency else nullcontext()

    def guarded(name: str, run: Callable[[], int]) -> int | Exception:
        try:
            with gate:
                return run()
        except Exception as error:  # noqa: BLE001  kept apart from the others
            log.exception("pipeline %s failed", name)
            return error

    if not runs:
        return {}
    with ThreadPoolExecutor(len(runs)) as pool:
        futures = {name: pool.submit(guarded, name, run) for name, run in runs.items()}
        return {name: f.result() for name, f in futures.items()}
