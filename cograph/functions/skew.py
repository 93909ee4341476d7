"""Joins and scratch tables that hold up when one key owns a third of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

SALTS = 16


def splittable_join(large: DataFrame, small: DataFrame, left_key: str, right_key: str, how: str = "inner",
                    extra: list[tuple[str, str]] | None = None) -> DataFrame:
    """Equi-join whose hot keys adaptive execution can split.

    AQE splits a skewed partition only if both join sides are shuffles made for
    the join itself; a side that comes out of an aggregate or a window on the
    same key brings its own partitioning, and a hot key stays in one task.  Both
    sides therefore also match on a value computed from the key (always 0), which
    no upstream partitioning covers.  The price is one more shuffle of the small
    side where it is not broadcast.  ``left_key``, ``right_key`` and ``extra``
    pairs are qualified names; the helper columns are dropped by the caller's select.
    """
    on = F.col(left_key) == F.col(right_key)
    for a, b in extra or []:
        on &= F.col(a) == F.col(b)
    return large.join(small, on & (_zero(left_key) == _zero(right_key)), how)


def _zero(key: str):
    # never null, so that no null filter is inferred below one side's exchange and both sides can still share one
    return F.hash(F.col(key)).bitwiseAND(F.lit(0))


def salted_join(large: DataFrame, small: DataFrame, on: str | list[str], how: str = "inner",
                spread: list[str] | None = None, salts: int = SALTS, hint: str | None = None) -> DataFrame:
    """Equi-join whose hot keys are spread over ``salts`` tasks.

    ``large`` may hold any number of rows per key: each row gets a salt from a
    hash of ``spread`` (default: all its columns).  ``small`` must hold a
    bounded number of rows per key and is repeated once per salt.  ``how`` is
    inner, left, left_semi or left_anti, so every row of ``large`` meets
    exactly one copy of ``small`` and the result is that of the plain join.
    Null keys never match, as in SQL.  ``hint`` names a join strategy; "merge"
    keeps a side from being broadcast on the strength of its compressed file size.
    """
    on = [on] if isinstance(on, str) else list(on)
    salted = large.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread or large.columns]),
                                              F.lit(salts)).cast("int"))
    copies = small.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    if hint:
        copies = copies.hint(hint)
    return salted.join(copies, [*on, "_salt"], how).drop("_salt")
