"""Token-sort similarity of names, 0 to 100."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

from statloom.functions.text import SPACE, strip


def sorted_words(text: Column) -> Column:
    """Comparable form of a name: Latin-1 letters dropped, other signs to spaces, lower case,
    words sorted."""
    plain = F.regexp_replace(text, r"[\x{80}-\x{FF}]", "")
    spaced = strip(F.lower(F.regexp_replace(plain, r"[^\p{L}\p{N}_]", " ")))
    return F.array_join(F.array_sort(F.split(spaced, SPACE)), " ")


def _short_lengths(xs: list[str], ys: list[str]) -> np.ndarray:
    """Common subsequence lengths of many short pairs at once, one table row per NumPy step."""
    x = np.array(xs).reshape(-1, 1).view(np.int32).T
    y = np.array(ys).reshape(-1, 1).view(np.int32).T.copy()
    y[y == 0] = -1  # paddings of the two sides must not match each other
    row = np.zeros((len(y) + 1, len(xs)), dtype=np.int8)
    for letter in x:
        best = row[:-1] + (y == letter)
        np.maximum(best, row[1:], out=best)
        np.maximum.accumulate(best, axis=0, out=row[1:])
    return row[-1].astype(np.int64)


def common_length(x: str, y: str) -> int:
    """Common subsequence length of one pair of any size, a whole table row per big-integer step."""
    where: dict[str, int] = {}
    for i, ch in enumerate(x):
        where[ch] = where.get(ch, 0) | (1 << i)
    full = (1 << len(x)) - 1
    rest = full
    for ch in y:
        met = rest & where.get(ch, 0)
        rest = ((rest + met) | (rest - met)) & full
    return len(x) - rest.bit_count()


def pair_scores(xs: pd.Series, ys: pd.Series) -> pd.Series:
    """Scores of prepared text pairs; short pairs are grouped by size to keep tables dense."""
    x, y = xs.tolist(), ys.tolist()
    nx = np.fromiter(map(len, x), dtype=np.int64, count=len(x))
    ny = np.fromiter(map(len, y), dtype=np.int64, count=len(y))
    longest = np.maximum(nx, ny)
    common = np.zeros(len(x), dtype=np.int64)
    low = 0
    for high in (8, 12, 16, 24, 32, 48, 64):
        pick = np.flatnonzero((longest > low) & (longest <= high) & (nx > 0) & (ny > 0))
        for start in range(0, len(pick), 4096):
            part = pick[start : start + 4096]
            common[part] = _short_lengths([x[i] for i in part], [y[i] for i in part])
        low = high
    for i in np.flatnonzero(longest > 64):
        common[i] = common_length(x[i], y[i]) if nx[i] and ny[i] else 0
    total = np.maximum(nx + ny, 1)
    return pd.Series(np.rint(100.0 * (2.0 * common / total)).astype(np.int32))


#: Similarity of two prepared texts as a column; pairs reach Python in Arrow batches. The same
#: table filling as nested array expressions costs about a millisecond per pair.
ratio = F.pandas_udf(pair_scores, IntegerType())


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Similarity of two names, 0 where one has no letters, NULL where one is NULL."""
    return F.when(a.isNotNull() & b.isNotNull(), ratio(_text(a), _text(b)))


def _text(name: Column) -> Column:
    return F.coalesce(sorted_words(name), F.lit(""))
