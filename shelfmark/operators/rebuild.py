"""Replace parts of a text by values that come from another table.

A text is cut into pieces by one pass of the pattern, and each match is parsed once; what is kept and
parsed matches are written, as both the keys and the new texts are made of them. Only the distinct
keys of the matches are joined; the pieces stay in their row, and the resolved keys come back as one
map per text. Texts without a match are neither written nor shuffled.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.text import even_pieces, odd_pieces, pieces
from shelfmark.session import hand_over
from shelfmark.skew import lookup_join


def resolve_keys(
    df: DataFrame, row_id: str, keys: Column, dim: DataFrame, key: str, value: str
) -> DataFrame:
    """Map from key to value for each row, for the keys found in ``dim``.

    A map is no larger than the row's own list of keys.
    """
    wanted = df.select(
        row_id, F.explode(F.array_distinct(F.array_compact(keys))).alias(key)
    )
    found = lookup_join(wanted, dim.select(key, value), key, "inner")
    return found.groupBy(row_id).agg(
        F.map_from_entries(F.collect_list(F.struct(key, value))).alias("_resolved")
    )


def replace_resolved(
    df: DataFrame,
    row_id: str,
    text: str,
    pattern: str,
    has_match: Column,
    parse: Callable[[Column], Column],
    dim: DataFrame,
    key: str,
    value: str,
    build: Callable[[Column, Column], Column],
) -> DataFrame:
    """Replace each match by ``build(parsed, value)``; the value is null for an unknown key.

    ``parse`` turns the array of matches into an array of structs with a field ``key``, null
    where nothing is to be looked up.
    """
    untouched = df.where(~F.coalesce(has_match, F.lit(False)))
    cut = hand_over(
        df.where(has_match)
        .withColumn("_pieces", pieces(text, pattern))
        .withColumns({"_kept": even_pieces("_pieces"), "_parsed": parse(odd_pieces("_pieces"))})
        .drop("_pieces", text),
        "pieces",
    )
    resolved = resolve_keys(cut, row_id, F.transform("_parsed", lambda p: p["key"]), dim, key, value)
    after = lambda kept, new: F.array(kept, F.coalesce(new, F.lit("")))
    # the new texts are zipped with what is kept: named inside a lambda they would be made anew for every match
    rebuilt = (
        cut.join(resolved, row_id, "left")
        .withColumn(
            "_valued",
            F.transform(
                "_parsed",
                lambda p: F.struct(
                    p.alias("p"), F.try_element_at(F.col("_resolved"), p["key"]).alias("v")
                ),
            ),
        )
        .withColumn("_new", F.transform("_valued", lambda m: build(m["p"], m["v"])))
        .withColumn(text, F.array_join(F.flatten(F.zip_with("_kept", "_new", after)), ""))
    )
    return untouched.unionByName(rebuilt.select(*df.columns))
