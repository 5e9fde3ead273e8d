"""Independent actions submitted from several driver threads.

Writing nine small tables one after another leaves most of a cluster idle
while each job's few tasks run; submitting independent writes from a few
driver threads lets Spark's scheduler run their tasks side by side (the
model builder of the original pipeline does the same with two threads).
Only actions without data dependencies between them are passed here.
"""

from __future__ import annotations

from collections.abc import Callable, Collection, Mapping, Sequence
from threading import Condition, Lock
from typing import TypeVar

from pyspark import InheritableThread

T = TypeVar("T")

DEFAULT_THREADS = 8


def run_all(actions: Sequence[Callable[[], T]], threads: int = DEFAULT_THREADS) -> list[T]:
    """Run ``actions`` (no dependencies between them); results in input order.

    The threads inherit the caller's Spark properties (scheduler pool, job
    group).  The first error is raised once the running actions have ended.
    """
    if threads <= 1 or len(actions) <= 1:
        return [action() for action in actions]
    results: list[T | None] = [None] * len(actions)
    errors: list[BaseException] = []
    waiting, lock = list(enumerate(actions)), Lock()

    def work() -> None:
        while True:
            with lock:
                if errors or not waiting:
                    return
                k, action = waiting.pop(0)
            try:
                results[k] = action()
            except BaseException as error:  # noqa: BLE001 - raised by the caller's thread
                with lock:
                    errors.append(error)

    pool = [InheritableThread(target=work) for _ in range(min(threads, len(actions)))]
    for thread in pool:
        thread.start()
    for thread in pool:
        thread.join()
    if errors:
        raise errors[0]
    return results


def run_graph(
    actions: Mapping[str, tuple[Collection[str], Callable[[], T]]], threads: int = DEFAULT_THREADS
) -> dict[str, T]:
    """Run ``{name: (names it needs, action)}``, each as soon as what it needs is done.

    A slow action delays only those that need it, not others of its layer.
    Needed names must be keys; a circle is an error.  After the first error no
    further action starts, and it is raised once the running ones have ended.
    """
    waiting = {name: set(needs) for name, (needs, _) in actions.items()}
    unknown = {n for needs in waiting.values() for n in needs} - set(actions)
    if unknown:
        raise ValueError(f"unknown: {', '.join(sorted(unknown))}")
    results: dict[str, T] = {}
    errors: list[BaseException] = []
    running: set[str] = set()
    changed = Condition()

    def next_ready() -> str | None:
        return next((name for name, needs in waiting.items() if needs <= results.keys()), None)

    def work() -> None:
        while True:
            with changed:
                while not errors and waiting and (name := next_ready()) is None:
                    if not running:
                        errors.append(ValueError(f"a circle among {', '.join(sorted(waiting))}"))
                        break
                    changed.wait()
                if errors or not waiting:
                    changed.notify_all()
                    return
                del waiting[name]
                running.add(name)
            try:
                done = actions[name][1]()
            except BaseException as error:  # noqa: BLE001 - raised by the caller's thread
                with changed:
                    errors.append(error)
                    running.discard(name)
                    changed.notify_all()
            else:
                with changed:
                    results[name] = done
                    running.discard(name)
                    changed.notify_all()

    pool = [InheritableThread(target=work) for _ in range(max(1, min(threads, len(actions))))]
    for thread in pool:
        thread.start()
    for thread in pool:
        thread.join()
    if errors:
        raise errors[0]
    return results
