"""Dotted catalog keys, paths and hashed ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fqn_build(*parts: str | Column, leaf: str | Column | None = None) -> Column:
    """Lower-case dotted key; dots inside ``leaf`` become underscores. Null if a part is null."""
    pieces = [(F.col(p) if isinstance(p, str) else p).cast("string") for p in parts]
    if leaf is not None:
        last = (F.col(leaf) if isinstance(leaf, str) else leaf).cast("string")
        pieces.append(F.replace(last, F.lit("."), F.lit("_")))
    key = pieces[0]
    for piece in pieces[1:]:
        key = F.concat(key, F.lit("."), piece)
    return F.lower(key)


# number of dotted parts of a key without and with a catalog in the schema name
_PARTS = {"data": (1, 1), "schema": (2, 3), "table": (3, 4), "column": (4, 5)}


def fqn_parse(key: str | Column, otype: str) -> Column:
    """Struct (ds, schema, table, column) of a key, null when the part count does not fit."""
    short, dotted = _PARTS["column" if otype == "attribute" else otype]
    parts = F.split(key, r"\.")
    n = F.size(parts)
    ds = parts[0].try_cast("bigint")
    text = F.lit(None).cast("string")
    schema = table = column = text
    if otype != "data":
        schema = F.when(n == short, parts[1]).otherwise(
            F.concat_ws(".", F.get(parts, F.lit(1)), F.get(parts, F.lit(2)))
        )
    if otype == "table":
        table = F.element_at(parts, -1)
    elif otype in ("column", "attribute"):
        table = F.try_element_at(parts, F.lit(-2))
        column = F.element_at(parts, -1)
    parsed = F.struct(
        ds.alias("ds"), schema.alias("schema"), table.alias("table"), column.alias("column")
    )
    return F.when(n.isin(short, dotted) & ds.isNotNull(), parsed)


def parent_path(path: str | Column, sep: str = "//") -> Column:
    """Path without its last part; null for a path of one part."""
    parts = F.split(path, _quoted(sep))
    return F.when(
        F.size(parts) > 1, F.array_join(F.slice(parts, 1, F.size(parts) - 1), sep)
    )


def leaf(path: str | Column, sep: str = "//") -> Column:
    return F.element_at(F.split(path, _quoted(sep)), -1)


def _quoted(text: str) -> str:
    return "\\Q" + text + "\\E"


def hash_id(text: str | Column, algo: str = "sha256", n: int = 16) -> Column:
    """First ``n`` hex characters of the SHA-2 digest; depends on the text alone."""
    bits = {"sha224": 224, "sha256": 256, "sha384": 384, "sha512": 512}[algo]
    return F.substring(F.sha2(F.col(text) if isinstance(text, str) else text, bits), 1, n)
