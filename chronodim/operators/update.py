"""``UPDATE d SET … FROM u WHERE d.on = u.on`` as a pure rewrite.

An UPDATE that matches a row twice sets it once, from any of the matches: the right
side is reduced to one row per ``on`` (the least, so that reruns agree), never fanned out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_HIT = "_upd_hit"


def update_from(d: DataFrame, u: DataFrame, on, set_: dict[str, Column],
                where: Column | None = None) -> DataFrame:
    """Left join ``d`` to ``u`` on ``on`` and rewrite the columns of ``set_``
    for matched rows that also satisfy ``where``.  Expressions may use any
    column of ``u`` (name them apart from ``d``'s)."""
    on = list(on)
    hit = F.col(_HIT)
    if where is not None:
        hit = hit & F.coalesce(where, F.lit(False))
    rest = [c for c in u.columns if c not in on]
    if rest:
        u = u.groupBy(*on).agg(F.min(F.struct(*rest)).alias("_upd")).select(*on, "_upd.*")
    else:
        u = u.select(*on).distinct()
    joined = d.join(u.withColumn(_HIT, F.lit(True)), on, "left")
    out = [F.when(F.coalesce(hit, F.lit(False)), set_[c]).otherwise(F.col(c)).alias(c) if c in set_ else F.col(c)
           for c in d.columns]
    return joined.select(*out)
