"""Bringing a type 2 history up to date: only what a batch of rows can change is computed anew."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from snaphist.operators.scd2 import forever, scd2
from snaphist.operators.skew import match_keys

VERSION_COLUMNS = ("effective_date", "end_date", "is_current", "hash_diff")

_SEED, _SINCE = "_seed", "_since"


def seeds(
    versions: DataFrame, batch: DataFrame, key: str, ts: str, tiebreak: Sequence[str] = ()
) -> DataFrame:
    """Per key of ``batch``, its last version (a struct, NULL if none) that starts before all the batch's rows.

    That version and all before it start where they did: a row changes nothing that starts earlier.
    """
    first = batch.groupBy(key).agg(F.coalesce(F.min(ts), forever()).alias(_SINCE))
    own = match_keys(versions, first, [key], "inner").where(F.col("effective_date") < F.col(_SINCE))
    whole = F.struct(*[F.col(c) for c in versions.columns])
    last = own.groupBy(key).agg(F.max_by(whole, _place("", ["effective_date", *tiebreak])).alias(_SEED))
    return match_keys(first.select(key), last, [key], "left")


def _place(prefix: str, columns: Sequence[str]) -> Column:
    """Columns below ``prefix`` as one value that compares as sorting by them does, NULL last."""
    parts = []
    for i, c in enumerate(columns):
        parts += [F.col(prefix + c).isNull().alias(f"n{i}"), F.col(prefix + c).alias(f"c{i}")]
    return F.struct(*parts)


def _with_seed(df: DataFrame, other: DataFrame, key: str) -> DataFrame:
    """Rows of ``df`` with the seed of their key; rows of other keys go."""
    renamed = other.withColumnRenamed(key, "_seed_key")
    return df.join(renamed, F.col(key).eqNullSafe(F.col("_seed_key")), "inner").drop("_seed_key")


def splice(
    versions: DataFrame,
    rows: DataFrame,
    seed: DataFrame,
    key: str,
    ts: str,
    tracked: Sequence[str],
    *,
    collapse: bool = True,
    tiebreak: Sequence[str] = (),
) -> DataFrame:
    """The versions of the keys in ``seed`` (see ``seeds``) once all of ``rows`` are known.

    ``rows`` are all rows of these keys, those of the batch included, or at least those after the seeds. Versions up to the
    seed stay; the seed and the rows after it make the rest, so a late row splits the version it falls
    in, or moves its end, and the versions after it are found as a full rebuild would find them.
    """
    columns = [c for c in versions.columns if c not in VERSION_COLUMNS]
    order = ["effective_date", *tiebreak]
    earlier = _place("", order) < _place(f"{_SEED}.", order)
    kept = _with_seed(versions, seed, key).where(F.col(_SEED).isNotNull() & earlier).select(*versions.columns)
    started = seed.where(F.col(_SEED).isNotNull()).select(*[F.col(f"{_SEED}.{c}").alias(c) for c in columns])
    after = _with_seed(rows.select(*columns), seed, key).where(
        F.col(_SEED).isNull() | F.col(ts).isNull() | (F.col(ts) > F.col(f"{_SEED}.effective_date"))
    )
    again = scd2(
        started.unionByName(after.select(*columns)), key, ts, tracked, collapse=collapse, tiebreak=tiebreak
    )
    return kept.unionByName(again.select(*versions.columns))
