"""Arrow helpers that the operators share."""

from __future__ import annotations

import ctypes
import functools
import gc
import inspect
import sys
import threading
import time
from collections.abc import Callable, Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Bytes of text that an operator looks at in one go.
CHUNK = 8 << 20
#: Bytes of text whose results a worker hands over in one go.
PART = 2 << 20
#: Seconds without work after which a worker gives its memory back.
REST = 1.0


def utf8(column: pa.Array) -> list[bytes]:
    """The texts as bytes; a null text is an empty one."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def chunks(sizes: list[int], limit: int = CHUNK) -> Iterator[slice]:
    """Slices of consecutive texts of about ``limit`` bytes; a longer text is one by itself."""
    start = total = 0
    for at, size in enumerate(sizes):
        if total and total + size > limit:
            yield slice(start, at)
            start, total = at, 0
        total += size
    if start < len(sizes):
        yield slice(start, len(sizes))


def parts(column: pa.Array, limit: int = CHUNK) -> Iterator[pa.Array]:
    """A column of texts in slices of about ``limit`` bytes."""
    sizes = np.array(pc.binary_length(column).fill_null(0))
    return (column[part] for part in chunks(sizes.tolist(), limit))


def slices(data: pa.Buffer | None, ends: np.ndarray, skip: int = 0) -> list[bytes]:
    """The bytes between neighbouring ``ends``, each without its first ``skip``."""
    view = memoryview(data or b"")
    return [bytes(view[a + skip:b]) for a, b in zip(ends.tolist(), ends[1:].tolist())]


def remainder(id_column: str, divisor: int) -> Column:
    """crc32 of an id's text modulo ``divisor``; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(id_column).cast("string"), F.lit("")).cast("binary")) % divisor


def _give_back() -> None:
    """Freed memory stays with the process otherwise, beside what comes next."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # the C library of Linux has it
    if trim is not None:
        trim(0)


def _memory() -> ModuleType:
    """A worker's memory; functions travel with the job, so their own module's globals are new in every task."""
    found = sys.modules.setdefault("_worker_memory", ModuleType("_worker_memory"))
    if "kept" not in found.__dict__:
        found.kept, found.owner, found.lock = {}, None, threading.Lock()
        found.busy, found.last, found.watched = 0, 0.0, False
    return found


def _watch() -> None:
    """Waits until the worker rests, and then forgets what it kept."""
    memory, waiting = _memory(), True
    while waiting:
        time.sleep(REST / 4)
        with memory.lock:
            waiting = memory.busy > 0 or time.monotonic() - memory.last < REST
            if not waiting:
                memory.kept.clear()
                memory.owner, memory.watched = None, False
    _give_back()


def rested(function: Callable) -> Callable:
    """``function`` of Arrow columns, after which a worker without further work gives its memory back.

    Spark keeps more workers than work at a time and takes them in turn, so what a stage learned and
    freed would lie beside the next stage's memory. A generator is at work until it ends; what it
    freed goes back then, as Arrow gives back a thread's memory only from that thread.
    """
    def begin() -> None:
        memory = _memory()
        with memory.lock:
            memory.busy += 1

    def end() -> None:
        memory = _memory()
        with memory.lock:
            memory.busy -= 1
            memory.last = time.monotonic()
            start, memory.watched = not memory.watched, True
        if start:
            threading.Thread(target=_watch, daemon=True).start()

    @functools.wraps(function)
    def run(*columns):
        begin()
        try:
            return function(*columns)
        finally:
            end()

    @functools.wraps(function)
    def run_on(*columns):
        begin()
        try:
            yield from function(*columns)
            _give_back()
        finally:
            end()

    return run_on if inspect.isgeneratorfunction(function) else run


def by_parts(kind: str, limit: int = PART) -> Callable:
    """Makes an Arrow function of type ``kind`` from one of a column of texts.

    It is given about ``limit`` bytes at a time, and each part's results go to Spark before the
    next part is looked at, so a worker holds those of one part and not of all rows that came.
    """
    def made(function: Callable[[pa.Array], pa.Array]) -> Callable[[Column], Column]:
        @F.arrow_udf(kind)
        @rested
        def run(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
            for column in columns:
                for part in parts(column, limit):
                    yield function(part)
        return run
    return made


def remembered(owner: str, name: str, make: Callable[[], object], key: object = None) -> object:
    """What a reused Python worker keeps from one task to the next, made on first use.

    With another ``key`` it is made anew. A worker keeps things of one ``owner`` only: when another
    operator comes to it, those of the one before go, back to the system. ``rested`` ones go sooner.
    """
    memory = _memory()
    with memory.lock:
        memory.last = time.monotonic()
        before = memory.owner
        if before != owner:
            memory.kept.clear()
            memory.owner = owner
        found = memory.kept.get(name)
    if before not in (None, owner):
        _give_back()
    if found is None or found[0] != key:
        found = key, make()
        with memory.lock:
            memory.kept[name] = found
    return found[1]
