"""Links, media and other references in tables of HTML articles."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.html import html_table
from shelfmark.functions.text import html_unescape, matches
from shelfmark.functions.values import filter_label, first_elem
from shelfmark.operators.lookups import mapping_join
from shelfmark.operators.rebuild import replace_resolved
from shelfmark.skew import lookup_join

ANCHOR = r"(?is)<a\s[^>]*>.*?</a\s*>"
INTERNAL = r"(?is)<a\s[^>]*data-otype[^>]*>([^<]+)</a\s*>"
IMAGE = r"(?is)<img\s[^>]*>"

# fixed values: entities that HTML writers escape; the ampersand has to be escaped first
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")]


def escape(text: Column) -> Column:
    for entity, char in reversed(ENTITIES):
        if char != "'":
            text = F.replace(text, F.lit(char), F.lit(entity))
    return text


_ATTRIBUTES = {"oid": "data-oid", "otype": "data-otype", "href": "href", "title": "title", "src": "src"}


def _attribute_pattern(name: str) -> str:
    return r"(?is)\s" + name + r"\s*=\s*(\"[^\"]*\"|'[^']*')"


def parse_elements(found: Column, *names: str) -> Column:
    """Elements as structs: ``whole``, ``opening`` tag and the named attributes.

    An attribute the tag does not have is null. The steps are nested so that each expression
    is evaluated once per element.
    """
    tags = F.transform(
        found,
        lambda e: F.struct(
            e.alias("whole"), F.regexp_extract(e, r"(?is)^<[^>]*>", 0).alias("opening")
        ),
    )
    # one list of values, so that the table of entities is in the plan once and not per attribute
    quoted = F.transform(
        tags,
        lambda t: F.struct(
            t["whole"].alias("whole"),
            t["opening"].alias("opening"),
            F.transform(
                F.array(*[F.regexp_extract(t["opening"], _attribute_pattern(_ATTRIBUTES[n]), 1) for n in names]),
                lambda raw: F.when(raw != "", html_unescape(F.substr(raw, F.lit(2), F.length(raw) - 2))),
            ).alias("values"),
        ),
    )
    return F.transform(
        quoted,
        lambda q: F.struct(
            q["whole"].alias("whole"),
            q["opening"].alias("opening"),
            *[q["values"][k].alias(n) for k, n in enumerate(names)],
        ),
    )


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value evaluated once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def inner_text(element: Column) -> Column:
    return _once(F.regexp_replace(element, r"<[^>]*>", ""), html_unescape)


def _attr(name: str, value: Column) -> Column:
    return F.concat(F.lit(f' {name}="'), value, F.lit('"'))


def _reopen(opening: Column, *attributes: Column) -> Column:
    """Opening tag without its reference attributes, with the given ones instead."""
    old = r"(?is)\s(?:href|data-oid|title)\s*=\s*(?:\"[^\"]*\"|'[^']*')|\s*>$"
    return F.concat(F.regexp_replace(opening, old, ""), *attributes, F.lit(">"))


def extract_links(df: DataFrame, row_id: str, html: str, tag: str = "a") -> DataFrame:
    """All anchors with their place in the text, attributes and text."""
    pattern = ANCHOR if tag == "a" else r"(?is)<" + tag + r"\s[^>]*>"
    parsed = parse_elements(matches(html, pattern), "href", "oid", "otype", "title")
    return df.select(row_id, F.posexplode(parsed).alias("pos", "e")).select(
        row_id,
        "pos",
        F.col("e.href").alias("href"),
        F.col("e.oid").alias("data_oid"),
        F.col("e.otype").alias("data_otype"),
        F.col("e.title").alias("title"),
        inner_text(F.col("e.whole")).alias("text"),
    )


def _is_reference(e: Column) -> Column:
    return e["oid"].isNotNull() & e["otype"].isNotNull()


def _with_key(parsed: Column, key: Callable[[Column], Column]) -> Column:
    return F.transform(parsed, lambda e: e.withField("key", key(e)))


def zero_refs(df: DataFrame, articles: DataFrame, row_id: str = "id", body: str = "body") -> DataFrame:
    """First pass before a migration: anchors keep the target's title and lose id and href.

    The title of an article comes from ``articles`` (``id``, ``title``) and also becomes the
    anchor's text; for other objects, and unknown articles, it is the text as it stands.
    """

    def parse(found: Column) -> Column:
        parsed = parse_elements(found, "oid", "otype")
        return _with_key(
            parsed, lambda e: F.when(_is_reference(e) & (e["otype"] == "article"), e["oid"])
        )

    def build(e: Column, title: Column) -> Column:
        content = F.regexp_extract(e["whole"], r"(?is)^<[^>]*>(.*)</a\s*>$", 1)
        zeroed = _once(
            escape(F.coalesce(title, inner_text(e["whole"]))),
            lambda shown: F.concat(
                _reopen(e["opening"], _attr("data-oid", F.lit("0")), _attr("title", shown)),
                F.when(e["key"].isNotNull(), shown).otherwise(content),
                F.lit("</a>"),
            ),
        )
        return F.when(_is_reference(e), zeroed).otherwise(e["whole"])

    dim = articles.select(
        F.col("id").cast("string").alias("_key"), F.col("title").alias("_title")
    )
    return replace_resolved(
        df, row_id, body, ANCHOR, F.col(body).contains("data-oid"), parse, dim, "_key", "_title", build
    )


def parse_references(found: Column) -> Column:
    """Parsed anchors with the key ``otype:title``; null for other links.

    A table is named by the first word of its title, case ignored.
    """

    def key(e: Column) -> Column:
        title = F.coalesce(e["title"], inner_text(e["whole"]))
        name = F.when(
            e["otype"] == "table", F.lower(F.regexp_extract(title, r"^\s*(\S+)", 1))
        ).otherwise(title)
        return F.when(_is_reference(e), F.concat(e["otype"], F.lit(":"), name))

    return _with_key(parse_elements(found, "oid", "otype", "title"), key)


# of several objects with one title, which one a reference means
POLICY = {"article": "first", "query": "last", "table": "last"}


def reference_dim(
    dims: Mapping[str, DataFrame], policy: Mapping[str, str] = POLICY
) -> DataFrame:
    """One id per ``otype:title`` from tables of (``title``, ``id``), by id order."""
    parts = []
    for otype, dim in dims.items():
        title = F.lower("title") if otype == "table" else F.col("title")
        best = F.min("id") if policy.get(otype, "first") == "first" else F.max("id")
        parts.append(
            dim.where("title is not null")
            .groupBy(F.concat(F.lit(f"{otype}:"), title).alias("_key"))
            .agg(best.cast("string").alias("_oid"))
        )
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def rewrite_refs(
    df: DataFrame,
    dims: Mapping[str, DataFrame],
    policy: Mapping[str, str] = POLICY,
    on_missing: str = "keep",
    row_id: str = "id",
    body: str = "body",
) -> DataFrame:
    """Second pass: anchors get the id and href of the object with their title.

    A reference to nothing stays as it is (``keep``) or loses id and href (``zero``). Types
    that ``dims`` does not cover are left alone.
    """

    def build(e: Column, oid: Column) -> Column:
        kept_title = F.coalesce(_attr("title", escape(e["title"])), F.lit(""))
        rest = F.substr(e["whole"], F.length(e["opening"]) + 1)
        href = F.concat(F.lit("/"), e["otype"], F.lit("/"), oid, F.lit("/"))
        linked = F.concat(
            _reopen(e["opening"], _attr("data-oid", oid), _attr("href", href), kept_title), rest
        )
        missing = e["whole"]
        if on_missing == "zero":
            zeroed = F.concat(_reopen(e["opening"], _attr("data-oid", F.lit("0")), kept_title), rest)
            known_type = F.coalesce(e["otype"].isin(*dims), F.lit(False))
            missing = F.when(_is_reference(e) & known_type, zeroed).otherwise(missing)
        return F.when(oid.isNotNull(), linked).otherwise(missing)

    return replace_resolved(
        df,
        row_id,
        body,
        ANCHOR,
        F.col(body).contains("data-oid"),
        parse_references,
        reference_dim(dims, policy),
        "_key",
        "_oid",
        build,
    )


def broken_refs(
    df: DataFrame, dims: Mapping[str, DataFrame], row_id: str = "id", body: str = "body"
) -> DataFrame:
    """References without a target, counted per document and type."""
    keys = F.transform(parse_references(matches(body, ANCHOR)), lambda e: e["key"])
    refs = (
        df.where(F.col(body).contains("data-oid"))
        .select(row_id, F.posexplode(F.array_compact(keys)).alias("_pos", "_key"))
        .withColumn("otype", F.substring_index("_key", ":", 1))
        .where(F.col("otype").isin(*dims))
    )
    lost = lookup_join(refs, reference_dim(dims).select("_key"), "_key", "left_anti")
    return lost.groupBy(row_id, "otype").agg(F.count("*").alias("broken"))


def media_files(
    df: DataFrame, stored: DataFrame, row_id: str, html: str, name: str = "name"
) -> DataFrame:
    """Images of each article and whether a file of that name is stored."""
    images = df.select(
        row_id, F.explode(parse_elements(matches(html, IMAGE), "src")).alias("e")
    ).select(row_id, "e.src")
    named = images.where("src is not null").withColumn(name, F.substring_index("src", "/", -1))
    have = stored.select(name).distinct().withColumn("stored", F.lit(True))
    return lookup_join(named, have, name).withColumn("stored", F.coalesce("stored", F.lit(False)))


def strip_internal_links(df: DataFrame, html: str) -> DataFrame:
    """Replace anchors to catalog objects by their text; other links stay."""
    return df.withColumn(html, F.regexp_replace(html, INTERNAL, "$1"))


# fixed values: entity labels that may be shown
APPROVED = ["PERSON", "NORP", "FAC", "ORG", "GPE", "EVENT", "WORK_OF_ART", "LAW"]


def entity_filter(
    df: DataFrame, entities: str = "entities", approved: Sequence[str] = APPROVED
) -> DataFrame:
    """Add the distinct texts of approved entities."""
    return df.withColumn(
        "ent", filter_label(entities, "entity_label", approved, "entity_text")
    )


def article_contributors(df: DataFrame, author: str = "author", editors: str = "editors") -> DataFrame:
    """Authors and editors, each person once."""
    people = F.concat(F.array(author), F.coalesce(editors, F.array().cast(df.schema[editors].dataType)))
    return df.select(F.explode(people).alias("p")).where("p is not null").distinct().select("p.*")


def row_articles(
    df: DataFrame,
    key_cols: Sequence[str],
    number: str,
    prefix: str = "",
    pickers: Sequence[str] = (),
) -> DataFrame:
    """Each row as an article: key, HTML table of its filled cells, and its picker values."""
    cells = [c for c in df.columns if c != number]
    key = F.concat_ws("-", F.lit(prefix), *[F.col(c) for c in [*key_cols, number]])
    return df.select(
        key.alias("key"),
        html_table(cells).alias("description"),
        *[F.col(c).alias((prefix + c)[:25]) for c in pickers],
    )


def article_to_term(
    articles: DataFrame, mapping: Mapping[str, tuple], template: str = "template"
) -> DataFrame:
    """Articles with a mapped template as rows of glossary terms.

    ``mapping`` is template -> (template id, glossary id). The first template of an article
    counts.
    """
    named = articles.withColumn(template, first_elem("templates"))
    return mapping_join(named, mapping, template, ["template_id", "glossary_id"]).select(
        "id", "title", F.col("body").alias("description"), "template_id", "glossary_id"
    )


