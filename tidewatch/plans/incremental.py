"""Silver and gold kept up to date from what has changed in bronze.

A change of a bronze table is known by its keys: those of rows added since the
version that silver was made from, or, where the table was written anew, those
whose rows differ by their hashes. Only these keys are cleaned, deduplicated and
scored again, and take the place of what silver and gold hold of them. A key
that bronze has lost leaves them. The outcome is that of making all anew.

A repeated update changes nothing, so a run that fails half way is repeated.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewatch.session import cut
from tidewatch.sizes import broadcast_if

_KEY = "_touched_"


def touched_keys(tables, since: dict[str, int], keys: list[str]) -> DataFrame:
    """The distinct keys that changed in any of the tables since its given version."""
    changed = [tables.changes(name, version, tables.latest(name), keys).select(*keys) for name, version in since.items()]
    return cut(reduce(DataFrame.unionAll, changed).distinct())


def _of(df: DataFrame, touched: DataFrame, keys: list[str], n: int, how: str) -> DataFrame:
    """The rows of `df` with (left_semi) or without (left_anti) a touched key; NULL is a key."""
    other = broadcast_if(touched.select(*[F.col(k).alias(_KEY + k) for k in keys]), n)
    same: Column = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(_KEY + k)) for k in keys])
    return df.join(other, same, how)


def replace_keys(tables, target: str, fresh: DataFrame, touched: DataFrame, keys: list[str], n: int) -> int:
    """The next version of `target`: its rows of untouched keys, and `fresh`.

    If it holds no touched key, `fresh` alone is written."""
    current = tables.read(target)
    if n == 0 or _of(current.select(*keys), touched, keys, n, "left_semi").isEmpty():
        return tables.append(fresh, target)
    stays = _of(current, touched, keys, n, "left_anti")
    return tables.overwrite(stays.unionByName(fresh.select(*current.columns)), target, same_schema=True)


def update(
    tables,
    sources: dict[str, int],
    keys: list[str],
    steps: list[tuple[str, Callable[..., DataFrame]]],
) -> dict[str, int]:
    """Bring the tables of `steps` up to date with those of `sources`, given with
    the versions they were made from. The first step makes rows of the sources'
    rows (one frame each), every other of the rows of the step before.

    Returns the versions written.
    """
    touched = touched_keys(tables, sources, keys)
    n = touched.count()
    inputs = [_of(tables.read(name), touched, keys, n, "left_semi") for name in sources]
    written = {}
    for name, step in steps:
        fresh = cut(step(*inputs))
        written[name] = replace_keys(tables, name, fresh, touched, keys, n)
        inputs = [fresh]
    return written
