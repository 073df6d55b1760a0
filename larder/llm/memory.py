"""How Python workers are set up: they live on between tasks and share their machine's cores and memory.

What a task has used is given back to the system at its end, and linear algebra runs in the calling thread: a worker
has about one core, so that more threads would only wait for each other.
"""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa

#: Groups of fewer bytes don't call for giving memory back.
LEAST = 1 << 20
#: Names under which builds of OpenBLAS export the number of threads.
_THREADS = ("scipy_openblas_set_num_threads64_", "openblas_set_num_threads64_", "openblas_set_num_threads")


@functools.lru_cache(1)
def settle_in() -> None:
    """Sets a worker up, once: Arrow buffers from the system's allocator, and one thread for numpy's linear algebra, where its library can be told."""
    pa.set_memory_pool(pa.system_memory_pool())
    for path in Path(np.__file__).parent.parent.glob("numpy.libs/*openblas*"):
        library = ctypes.CDLL(str(path))
        for name in _THREADS:
            if hasattr(library, name):
                getattr(library, name)(1)


def trim() -> None:
    """Returns freed memory to the system, where the C library can."""
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """run over batches, in a worker that is set up, with memory given back after large batches and at the end."""

    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            large = batch.nbytes > LEAST
            yield batch
            if large:
                trim()

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        settle_in()
        yield from run(trimmed(batches))
        trim()

    return wrapped


def lean_group(run: Callable[[pa.Table], pa.Table]):
    """The same for a function of one grouped table."""

    def one(rows: pa.Table) -> pa.Table:
        settle_in()
        out = run(rows)
        if rows.nbytes > LEAST:
            trim()
        return out

    return one


def lean_pair(run: Callable[[pa.Table, pa.Table], pa.Table]):
    """The same for a function of two tables grouped together."""

    def two(left: pa.Table, right: pa.Table) -> pa.Table:
        settle_in()
        out = run(left, right)
        if left.nbytes + right.nbytes > LEAST:
            trim()
        return out

    return two
