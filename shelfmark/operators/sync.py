"""What has to change on a target so that it equals the source."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sync_plan(
    source: DataFrame,
    target: DataFrame,
    key: Sequence[str],
    compare: Sequence[str],
    remove_not_seen: bool = False,
    action: str | None = None,
) -> DataFrame:
    """One row per key with its operation ``op`` (create, update, keep, delete or conflict) and the
    number of rows that source and target have of it (``n_source``, ``n_target``).

    A key that either side has more than once is a conflict, and nothing else is planned for it.
    Null is a value of a key like any other. Objects the source does not have are deleted only
    with ``remove_not_seen``; source rows with ``delete`` in the column ``action`` always are, and
    need nothing (no row) if the target does not have them.

    Both sides are grouped by key as one table, and what is compared travels as one hash. So rows are
    counted where they are read, and a key of any number of rows is one row a task in the shuffle.
    """

    def side(df: DataFrame, name: str, dropped: Column) -> DataFrame:
        cells = F.to_json(F.struct(*compare), {"ignoreNullFields": "false"})
        own, other = ("source", "target") if name == "source" else ("target", "source")
        return df.select(
            *key,
            F.lit(1).cast("bigint").alias(f"n_{own}"),
            F.lit(0).cast("bigint").alias(f"n_{other}"),
            F.sha2(cells, 256).alias(f"h_{own}"),
            F.lit(None).cast("string").alias(f"h_{other}"),
            F.coalesce(dropped, F.lit(False)).alias("dropped"),
        )

    asked = (F.col(action) == "delete") if action else F.lit(False)
    rows = side(source, "source", asked).unionByName(side(target, "target", F.lit(False)))
    found = rows.groupBy(*key).agg(
        *[F.sum(n).alias(n) for n in ("n_source", "n_target")],
        *[F.min(h).alias(h) for h in ("h_source", "h_target")],
        F.bool_or("dropped").alias("dropped"),
    )
    here, there = F.col("n_source") > 0, F.col("n_target") > 0
    op = (
        F.when((F.col("n_source") > 1) | (F.col("n_target") > 1), F.lit("conflict"))
        .when(F.col("dropped"), F.when(there, F.lit("delete")))
        .when(~here, F.lit("delete") if remove_not_seen else F.lit("keep"))
        .when(~there, F.lit("create"))
        .when(F.col("h_source") != F.col("h_target"), F.lit("update"))
        .otherwise(F.lit("keep"))
    )
    return found.select(*key, op.alias("op"), "n_source", "n_target").where("op is not null")
