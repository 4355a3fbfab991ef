"""Array column functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def field(arr, name: str) -> Column:
    """One field of every struct in an array."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.transform(a, lambda e: e[name])


def shift_left(arr, n: int = 1) -> Column:
    """Element i takes element i+n; the last n become null (``try_element_at``
    is 1-based and null past the end)."""
    a = F.col(arr) if isinstance(arr, str) else arr
    return F.transform(a, lambda x, i: F.try_element_at(a, i + 1 + n))


def count_in(arr, values) -> Column:
    """How many elements are in ``values``."""
    a = F.col(arr) if isinstance(arr, str) else arr
    vals = [str(v) for v in values]
    return F.size(F.filter(a, lambda x: x.isin(vals)))


def explode_parallel(*arrays: Column) -> Column:
    """Explode equally long arrays together (generator over ``arrays_zip``)."""
    return F.inline(F.arrays_zip(*arrays))
