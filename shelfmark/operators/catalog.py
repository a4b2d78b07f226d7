"""Catalog rows: keys, types, dictionaries and DDL."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmark.functions.keys import fqn_build
from shelfmark.functions.text import regex_map
from shelfmark.skew import joined_lists


def catalog_from_sheet(
    sheet: DataFrame, schema: str, table: str, column: str, ctype: str, ds: str, order: str
) -> DataFrame:
    """Schema, table and column keys of a flat sheet; a repeated column keeps its first type.

    Every row gives the levels for which it has names, and one aggregate makes them distinct.
    """

    def level(number: int, *cols: str) -> Column:
        # concat is null as soon as one name is
        key = F.lit(ds)
        for c in cols:
            key = F.concat(key, F.lit("."), F.col(c))
        entry = F.struct(
            F.lit(number).alias("level"),
            key.alias("key"),
            (F.col(ctype) if number == 3 else F.lit(None).cast("string")).alias("ctype"),
        )
        return F.when(key.isNotNull(), entry)

    levels = F.array_compact(
        F.array(level(1, schema), level(2, schema, table), level(3, schema, table, column))
    )
    return (
        sheet.select(F.col(order).alias("_order"), F.explode(levels).alias("l"))
        .groupBy("l.level", "l.key")
        .agg(F.min_by("l.ctype", "_order").alias("column_type"))
        .select(
            "key", F.when(F.col("level") == 2, F.lit("TABLE")).alias("table_type"), "column_type"
        )
    )


def data_dictionary(
    ds: DataFrame, schemas: DataFrame, tables: DataFrame, columns: DataFrame
) -> DataFrame:
    """All levels of the catalog in one table with dotted keys and the ids that apply."""

    def level(df: DataFrame, key: Column, **ids: str) -> DataFrame:
        return df.select(
            key.alias("key"),
            "title",
            "description",
            *[F.col(c).cast("string").alias(name) for name, c in ids.items()],
        )

    ds_id = F.col("ds_id").cast("string")
    parts = [
        level(ds, ds_id),
        level(schemas, F.concat_ws(".", ds_id, "name"), schema_id="id"),
        level(
            tables, F.concat_ws(".", ds_id, "schema_name", "name"), schema_id="schema_id", table_id="id"
        ),
        level(
            columns,
            F.concat_ws(".", ds_id, "table_name", "name"),
            schema_id="schema_id",
            table_id="table_id",
            column_id="id",
            data_type="data_type",
        ),
    ]
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part, allowMissingColumns=True)
    return whole


def rekey_catalog(df: DataFrame, key: str, new_ds: int | str) -> DataFrame:
    """Put the rows under another data source: the first part of the key changes."""
    return df.withColumn(key, F.regexp_replace(key, r"^[^.]+", str(new_ds)))


# fixed values: codes of the extraction adapters
TABLE_TYPES = {0: "TABLE", 1: "VIEW", 3: "SYNONYM"}
COLUMN_TYPES = {
    0: "OTHER",
    1: "BOOL",
    2: "DATE",
    3: "INT",
    4: "FLOAT",
    5: "STRING",
    6: "TIME",
    7: "TIMESTAMP",
}


def _stripped(value: Column, kind: T.DataType, codes: Mapping[int, str]) -> Column:
    """Struct of the fields that end in an underscore, without it; codes become names."""
    if not isinstance(kind, T.StructType):
        return value
    fields = []
    for field in kind.fields:
        if not field.name.endswith("_"):
            continue
        inner = value.getField(field.name)
        if field.name == "normalized_":
            if not isinstance(field.dataType, T.IntegralType):
                continue
            names = F.lit(None).cast("string")
            for code, name in codes.items():
                names = F.when(inner == code, F.lit(name)).otherwise(names)
            fields.append(names.alias("normalized"))
        else:
            fields.append(_stripped(inner, field.dataType, codes).alias(field.name[:-1]))
    return F.struct(*fields)


def normalize_dump(
    raw: DataFrame,
    codes: Mapping[int, str],
    blacklist: Sequence[str],
    has_catalog: bool,
    kind: str,
) -> DataFrame:
    """Adapter dump lines with plain names, decoded types and the lower-case schema.

    ``kind`` is schema, table or column. Objects of blacklisted schemas are left out.
    """
    cols = [
        _stripped(F.col(f.name), f.dataType, codes).alias(f.name[:-1])
        for f in raw.schema.fields
        if f.name.endswith("_")
    ]
    plain = raw.select(*cols)
    name = F.col("id.name.original") if kind == "schema" else F.col("id.schema.original")
    if has_catalog:
        name = F.concat(F.col("id.databaseCatalog.original"), F.lit("."), name)
    return plain.withColumn("lower_schema", F.lower(name)).where(
        ~F.coalesce(F.col("lower_schema").isin(*blacklist), F.lit(False))
    )


def catalog_amalgam(schema: DataFrame, table: DataFrame, column: DataFrame) -> DataFrame:
    """Keys of all levels from normalized dumps, with types; blanks where there is none."""
    schemas = schema.select(F.col("lower_schema").alias("key"))
    tables = table.select(
        fqn_build("lower_schema", F.col("id.name.original")).alias("key"),
        F.col("type.normalized").alias("table_type"),
    )
    columns = column.select(
        fqn_build(
            "lower_schema", F.col("id.table.original"), leaf=F.col("id.name.original")
        ).alias("key"),
        F.col("type.normalized").alias("column_type"),
    )
    return (
        schemas.unionByName(tables, allowMissingColumns=True)
        .unionByName(columns, allowMissingColumns=True)
        .na.fill("")
    )


# fixed values: source column types (pattern, case ignored) and the type used instead; the first
# hit counts
TYPE_RULES = [
    (r"^(small)?datetime", "timestamp"),
    (r"^timestamp_ltz", "timestamp with time zone"),
    (r"^(timestamp_ntz|smalltimestamp)", "timestamp"),
    (r"^string", "text"),
    (r"^text\(max\)", "text"),
    (r"^(long|medium|short)?text(\(\d+\))?", "text"),
    (r"^(number|double|float|numeric)(\(\d+\))?", "numeric"),
    (r"^integer(\d)?", "integer"),
    (r"^(big|small)?integer(\d)?", "integer"),
    (r"^(big|small)?integer(\(\d+\))?", "integer"),
    (r"^(big|small)?_integer(\d)?", "integer[]"),
    (r"^(tiny|byte|big)?int(\(\d+\))?", "integer"),
    (r"^(tiny|byte|big)?int\d?", "integer"),
    (r"^bytes$", "text"),
    (r"^geography", "polygon"),
    (r"^(varchar|nvarchar)\(max\)", "text"),
    (r"^(varchar|nvarchar)(\(\d+\))?", "text"),
    (r"^varbinary\(max\)", "bytea"),
    (r"^binary\(max\)", "bytea"),
    (r"^(var)?binary(\(\d+\))?", "bytea"),
    (r"^(na|hstore|id|picklist|reference|textarea|url|address|email|clob)(\(\d+\))?", "text"),
    (r"^(num|variant|enum|measures|uniqueidentifier|accountnumeric)(\(\d+\))?", "numeric"),
]


def map_types(
    cols: DataFrame, type_col: str = "attribute_type", rules: Sequence[tuple[str, str]] = TYPE_RULES
) -> tuple[DataFrame, DataFrame]:
    """Columns with the mapped type, and how often each type was replaced or left as it is.

    The cascade runs once per distinct type in the second table.
    """
    mapped = cols.withColumn("mapped_type", regex_map(type_col, rules))
    any_rule = F.lit(False)
    for pattern, _ in rules:
        any_rule = any_rule | F.col(type_col).rlike("(?i)" + pattern)
    stats = (
        cols.groupBy(type_col)
        .agg(F.count("*").alias("n"))
        .withColumn("mapped_type", regex_map(type_col, rules))
        .withColumn("replaced", any_rule)
    )
    return mapped, stats


def table_ddl(cols: DataFrame, size: int = 5_000, type_col: str = "mapped_type") -> DataFrame:
    """DDL per table: columns by position, NOT NULL where a column is not nullable.

    A table with more than ``size`` columns gets further ALTER TABLE statements (``part`` 1,
    2, ...), so that no statement is larger than that.
    """
    define = F.concat(
        F.lit('"'), F.col("attribute_name"), F.lit('" '), F.col(type_col),
        F.when(F.col("nullable"), F.lit("")).otherwise(F.lit(" NOT NULL")),
    )
    lists = joined_lists(
        cols, ["schema_name", "table_name"], ["position", "attribute_name"], define, size, "defs"
    )
    table = F.concat(
        F.lit('"'), F.col("schema_name"), F.lit('"."'), F.col("table_name"), F.lit('"')
    )
    create = F.concat(
        F.lit("CREATE TABLE IF NOT EXISTS "), table, F.lit("("), F.array_join("defs", ","), F.lit(")")
    )
    alter = F.concat(
        F.lit("ALTER TABLE "), table, F.lit(" ADD COLUMN "), F.array_join("defs", ", ADD COLUMN ")
    )
    return lists.select(
        "schema_name",
        "table_name",
        "part",
        F.when(F.col("part") == 0, create).otherwise(alter).alias("ddl"),
    )
