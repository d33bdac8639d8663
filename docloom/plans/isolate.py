"""Work on many files, in slices that are halved until a file that breaks its worker is alone.

A failed write leaves nothing behind, so a slice can be tried again in two halves: the files
beside the bad one are done by then, and the bad one is known.  Slices are conditions
on a hash of the key; the driver holds no list of files.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FAILURES = (PySparkException, Py4JJavaError)
#: Two keys that agree in so many bits of their hash are not told apart any more.
_DEEPEST = 62


@dataclass(frozen=True)
class Slice:
    """Keys whose hash leaves ``rest`` modulo ``parts``; ``tries`` is how often they have been tried."""

    parts: int
    rest: int
    tries: int = 0

    def holds(self, key: str) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(self.parts)) == F.lit(self.rest)

    def halves(self) -> list[Slice]:
        return [Slice(2 * self.parts, self.rest + side * self.parts, self.tries + 1) for side in (1, 0)]


def isolated(
    files: DataFrame,
    work: Callable[[DataFrame, int], None],
    alone: Callable[[DataFrame, int, Exception], None],
    healthy: Callable[[], None],
    parts: int = 1,
    key: str = "doc_id",
) -> int:
    """Do ``work`` on every slice of ``files``; the number of files that failed alone.

    ``work`` gets a slice and the number of this try, and commits all of it or nothing.  If it
    fails, ``healthy`` runs first: it does the same kind of write without any file, and what it
    raises (a full disk, a lost store) is no file's fault and ends the work.  Then the slice is
    halved, or handed to ``alone`` if it holds one key.
    """
    left = [Slice(parts, rest) for rest in reversed(range(parts))]
    bad = 0
    while left:
        one = left.pop()
        rows = files.where(one.holds(key))
        try:
            work(rows, one.tries + 1)
        except FAILURES as error:
            healthy()
            if one.parts >= 1 << _DEEPEST or rows.select(key).distinct().limit(2).count() < 2:
                alone(rows, one.tries + 1, error)
                bad += 1
            else:
                left += one.halves()
    return bad
