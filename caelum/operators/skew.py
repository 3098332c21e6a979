"""Joining group facts to rows whose groups may be of any size."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caelum.session import cut

SALTS = 16


def join_facts(rows: DataFrame, facts: DataFrame, on: list[str], how: str = "left", salts: int = SALTS) -> DataFrame:
    """``rows`` with the columns of ``facts``, of which each key of ``on`` has one row.

    A key's rows are dealt to ``salts`` tasks by a hash of the whole row, the one row of facts goes to each of them: no task
    gets all rows of a large group or of a NULL key, whatever adaptive execution makes of the join.
    """
    salt = F.pmod(F.xxhash64(*[F.col(c) for c in rows.columns]), F.lit(salts)).cast("int")
    dealt = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return rows.withColumn("_salt", salt).join(dealt, [*on, "_salt"], how).drop("_salt")


def join_counted(rows: DataFrame, facts: DataFrame, on: list[str], copies: str, each: int, how: str = "left") -> DataFrame:
    """``rows`` with the columns of ``facts``, where facts may be nearly as many as rows: one row a key, ``copies`` rows asking for it.

    A key's rows go to one task for every ``each`` of them, so to one for most keys, whose fact is not copied then. Keys that
    more rows ask for are few; they are written first, so that rows learn of them without being moved. Rows with a NULL key
    find nothing and are spread.
    """
    parts = F.ceil(F.col(copies) / each)
    hot = cut(facts.where(F.col(copies) > each).select(*on, parts.cast("int").alias("_parts")), "hot-keys")
    lost = F.lit(False)
    for c in on:
        lost = lost | F.col(c).isNull()
    spread = F.xxhash64(*[F.col(c) for c in rows.columns])
    salt = F.when(lost, F.pmod(spread, F.lit(SALTS))).when(F.col("_parts").isNotNull(), F.pmod(spread, F.col("_parts"))).otherwise(0)
    dealt = facts.withColumn("_salt", F.explode(F.sequence(F.lit(0), parts.cast("int") - 1))).drop(copies)
    salted = rows.join(hot, on, "left").withColumn("_salt", salt.cast("int")).drop("_parts")
    return salted.join(dealt, [*on, "_salt"], how).drop("_salt")
