"""Joining one row per group onto very many rows, whatever the number of groups and however uneven they are."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridcast.sources.tables import cut

BROADCAST_GROUPS = 100_000
SALTS = 32


def join_null_safe(left: DataFrame, right: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Inner or left join on columns of the same names in which NULL equals NULL; the columns appear once."""
    named = right.withColumnsRenamed({c: f"_key_{c}" for c in by})
    same = [F.col(c).eqNullSafe(F.col(f"_key_{c}")) for c in by]
    return left.join(named, same, how).drop(*[f"_key_{c}" for c in by])


def join_groups(rows: DataFrame, groups: DataFrame, by: Sequence[str], how: str = "inner") -> DataFrame:
    """Inner or left join of ``rows`` with ``groups``, which has one row of a few hundred bytes per group; NULL is a group too.

    ``groups`` is stored first and its rows are counted. Up to ``BROADCAST_GROUPS`` of them are broadcast, so the large
    side isn't shuffled. Beyond that the join is salted: each group's row is copied ``SALTS`` times and a hot group's rows
    are spread over that many tasks.
    """
    stored = cut(groups)
    if not by:
        return rows.join(F.broadcast(stored), F.lit(True), how)  # one row
    if stored.count() <= BROADCAST_GROUPS:
        return join_null_safe(rows, F.broadcast(stored), by, how)
    copies = stored.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    others = [c for c in rows.columns if c not in by]
    # The row's own values choose its task; equal rows are told apart by where they are read.
    spread = F.pmod(F.xxhash64(*others, F.monotonically_increasing_id()), F.lit(SALTS)).cast("int")
    return join_null_safe(rows.withColumn("_salt", spread), copies, [*by, "_salt"], how).drop("_salt")
