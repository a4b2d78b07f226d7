"""Column profiles, quality rules and warnings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmark.skew import joined_lists

# A sketch with 512 registers of which at most 120 are set estimates less than 500, so a
# column with no more than SKETCH_SURE values is never estimated above SKETCH_LIMIT.
SKETCH_SURE, SKETCH_LIMIT, SKETCH_ERROR = 120, 1000, 0.05


def _unpivoted(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    texts = df.select(*[F.col(c).cast("string").alias(c) for c in cols])
    return texts.unpivot([], list(cols), "col", "value").where("value is not null")


def value_counts(df: DataFrame, cols: Sequence[str], lo: int, hi: int) -> DataFrame:
    """Count of each value of the columns with more than ``lo`` and at most ``hi`` values.

    One pass with a sketch per column sets the columns with far too many values aside, so ids
    and texts are not shuffled; the others are counted exactly.
    """
    cols = list(cols)
    if cols and hi <= SKETCH_SURE:
        sketch = df.agg(*[F.approx_count_distinct(c, SKETCH_ERROR).alias(c) for c in cols]).first()
        cols = [c for c in cols if sketch[c] <= SKETCH_LIMIT]
    if not cols:
        return df.sparkSession.createDataFrame([], "col string, value string, n bigint")
    counts = _unpivoted(df, cols).groupBy("col", "value").agg(F.count("*").alias("n"))
    passing = counts.groupBy("col").agg(F.count("*").alias("_values")).where(
        F.col("_values").between(lo + 1, hi)
    )
    # one row per column at most
    return counts.join(F.broadcast(passing.select("col")), "col")


def value_frequency(
    df: DataFrame, cols: Sequence[str], lo: int = 20, hi: int = 120, k: int = 10
) -> DataFrame:
    """The ``k`` most frequent values of each column that qualifies; ties by value."""
    rank = Window.partitionBy("col").orderBy(F.desc("n"), "value")
    return (
        value_counts(df, cols, lo, hi)
        .withColumn("rank", F.row_number().over(rank))
        .where(F.col("rank") <= k)
    )


def _hashed(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """(col, h1, h2): number of the column and 128 bits of the value of every filled cell."""

    def cell(number: int, name: str) -> Column:
        value = F.col(f"`{name}`").cast("string")
        hashes = F.struct(
            F.lit(number).alias("col"), F.xxhash64(value).alias("h1"), F.xxhash64(F.lit("2"), value).alias("h2")
        )
        return F.when(value.isNotNull(), hashes)

    cells = F.array(*[cell(k, c) for k, c in enumerate(cols)])
    return df.select(F.explode(F.array_compact(cells)).alias("c")).select("c.*")


def profile_columns(
    df: DataFrame, cols: Sequence[str] | None = None, min_group: int = 5, min_cover: float = 0.25
) -> DataFrame:
    """Per column: filled rows, distinct values, largest group, and whether it is of interest.

    That is, a value occurs more than ``min_group`` times or more than ``min_cover`` of the
    rows are filled. Values are counted by column and 128-bit hash, so a cell is 20 bytes in the
    shuffle whatever its text, and equal ones are added up before it; what is then grouped by column
    is one row a task. Two of 10 ** 12 different values share a hash with a chance of 10 ** -15.
    """
    cols = list(cols or df.columns)
    total = df.agg(F.count("*")).scalar()
    names = df.sparkSession.createDataFrame(list(enumerate(cols)), "no int, col string")
    counts = _hashed(df, cols).groupBy("col", "h1", "h2").agg(F.count("*").alias("n"))
    found = counts.groupBy(F.col("col").alias("no")).agg(
        F.sum("n").alias("filled"), F.count("*").alias("distinct"), F.max("n").alias("largest")
    )
    return (
        names.join(found, "no", "left")
        .drop("no")
        .na.fill(0)
        .withColumn(
            "interesting",
            (F.col("largest") > min_group) | (F.col("filled") > total * F.lit(min_cover)),
        )
    )


def dq_evaluate(
    df: DataFrame, object_key: str, rules: Sequence[tuple[str, str, str]], object_type: str = "ATTRIBUTE"
) -> DataFrame:
    """Result of each rule (field key, column, condition) with its number of failing rows.

    All rules are counted in one pass. A row fails if the condition is not true. A rule on a
    column that is not there has the status UNKNOWN.
    """
    present = [r for r in rules if r[1] in df.columns]
    failing = [
        F.count_if(~F.coalesce(F.expr(condition), F.lit(False))).alias(f"r{i}")
        for i, (_, _, condition) in enumerate(present)
    ]
    if failing:
        counted = df.agg(*failing)
    else:
        counted = df.sparkSession.range(1)
    results = [
        F.struct(
            F.lit(key).alias("field_key"),
            F.lit(f"{object_key}.{column}").alias("object_key"),
            F.lit(object_type).alias("object_type"),
            F.when(F.col(f"r{i}") == 0, F.lit("GOOD")).otherwise(F.lit("ALERT")).alias("status"),
            F.col(f"r{i}").alias("value"),
        )
        for i, (key, column, _) in enumerate(present)
    ] + [
        F.struct(
            F.lit(key).alias("field_key"),
            F.lit(f"{object_key}.{column}").alias("object_key"),
            F.lit(object_type).alias("object_type"),
            F.lit("UNKNOWN").alias("status"),
            F.lit(None).cast("bigint").alias("value"),
        )
        for key, column, _ in rules
        if column not in df.columns
    ]
    return counted.select(F.explode(F.array(*results)).alias("r")).select("r.*")


def flag_tables(
    tables: DataFrame,
    flags: DataFrame,
    reason: str = "Missing tables: ",
    key: str = "ds",
    size: int = 10_000,
) -> DataFrame:
    """Warning per data source that lists its flagged tables, after a warning already there.

    ``tables`` has (``ds``, ``table``), ``flags`` (``ds``, ``flag_reason``). More than ``size``
    tables give further warnings (``part`` 1, 2, ...).
    """
    lists = joined_lists(tables, [key], ["table"], F.col("table"), size, "tables")
    text = F.concat(
        F.when(F.col("part") == 0, F.coalesce("flag_reason", F.lit(""))).otherwise(F.lit("")),
        F.lit(reason),
        F.array_join("tables", ", "),
    )
    return lists.join(flags, key, "left").select(
        key,
        "part",
        F.lit("WARNING").alias("flag_type"),
        F.when(F.col("flag_reason").isNull(), F.lit("create")).otherwise(F.lit("update")).alias("op"),
        text.alias("flag_reason"),
    )
