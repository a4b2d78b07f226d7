"""Value coercion, buckets, arrays, JSON and polymorphic values."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.keys import hash_id


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def to_int(column: str | Column) -> Column:
    """Number or numeric text as a whole number, half to even; null gives 0, junk gives null."""
    col = _col(column)
    number = col.cast("string").try_cast("double")
    whole = F.bround(F.when(~F.isnan(number), number))
    return F.when(col.isNull() | F.isnan(number), F.lit(0).cast("bigint")).otherwise(
        whole.try_cast("bigint")
    )


def valid_float(column: str | Column) -> Column:
    number = _col(column).cast("string").try_cast("double")
    return F.coalesce(F.when(~F.isnan(number), number), F.lit(0.0))


def valid_text(column: str | Column) -> Column:
    return F.coalesce(_col(column).cast("string"), F.lit("null"))


def report_type(column: str | Column) -> Column:
    return F.when(F.lower(column) == "dashboard", F.lit("dashboard")).otherwise(F.lit("simple"))


def valid_external_id(column: str | Column, *identity: str | Column) -> Column:
    """The id, or a stable hash of the identifying columns where it is missing or blank."""
    col = _col(column)
    made = hash_id(F.concat_ws("\u0001", *[_col(c).cast("string") for c in identity]))
    return F.when(F.trim(col) != "", col).otherwise(made)


RULES: dict[str, Callable[[Column], Column]] = {
    "int": to_int,
    "float": valid_float,
    "text": valid_text,
    "report_type": report_type,
}


def case_bucket(value: Column, steps: Sequence[tuple[float, str]], default: str | None) -> Column:
    """Label of the first threshold (given highest first) that the value exceeds."""
    chain = F
    for threshold, label in steps:
        chain = chain.when(value > threshold, F.lit(label))
    return chain.otherwise(F.lit(default))


def megabytes(size: str | Column) -> Column:
    return _col(size) / F.lit(1 << 20)


def scaled_log10(value: str | Column, digits: int = 6) -> Column:
    return F.round(F.log10(_col(value)), digits)


def first_elem(array: str | Column) -> Column:
    """First element, null for an empty or missing array."""
    return F.get(_col(array), F.lit(0))


def filter_label(array: str | Column, label: str, labels: Sequence[str], value: str) -> Column:
    """Distinct ``value`` of the array's structs whose ``label`` is one of ``labels``."""
    kept = F.filter(_col(array), lambda e: e[label].isin(*labels))
    return F.array_distinct(F.transform(kept, lambda e: e[value]))


def flatten(array: str | Column) -> Column:
    """Elements of the inner arrays in one array; missing inner arrays count as empty."""
    return F.flatten(F.filter(_col(array), lambda inner: inner.isNotNull()))


def json_scalar(column: str | Column, path: str) -> Column:
    return F.get_json_object(_col(column), path)


def json_entries(column: str | Column) -> Column:
    """Object text as a map from key to text value."""
    return F.from_json(_col(column), T.MapType(T.StringType(), T.StringType()))


def json_normalize(df: DataFrame, sep: str = ".") -> DataFrame:
    """One flat column per nested struct field, named by its path."""

    def leaves(schema: T.StructType, path: tuple[str, ...]) -> list[Column]:
        found = []
        for field in schema.fields:
            here = (*path, field.name)
            if isinstance(field.dataType, T.StructType):
                found += leaves(field.dataType, here)
            else:
                quoted = ".".join(f"`{p}`" for p in here)
                found.append(F.col(quoted).alias(sep.join(here)))
        return found

    return df.select(*leaves(df.schema, ()))


def describe_value(value: str | Column, fields: Sequence[str]) -> Column:
    """One text for a polymorphic struct: download link, user name, URL, or type:name=value."""
    struct = _col(value)
    choices = []
    if "download_url" in fields:
        choices.append(struct["download_url"])
    if "username" in fields:
        choices.append(struct["username"])
    if "otype" in fields and "url" in fields:
        choices.append(F.when(struct["otype"].isNotNull(), struct["url"]))
    if "field_name" in fields:
        choices.append(
            F.concat(
                struct["value_type"], F.lit(":"), struct["field_name"], F.lit("="), struct["value"]
            )
        )
    choices.append(F.to_json(struct))
    return F.coalesce(*choices)
