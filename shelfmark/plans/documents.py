"""Registered queries: links, references and articles."""

from pyspark.sql import functions as F

from shelfmark.operators import documents as D
from shelfmark.plans import fixtures as X
from shelfmark.plans.registry import query

_TAG = r"(?is)<a\s[^>]*>.*?</a\s*>"
_HREF = r"""(?is)\shref\s*=\s*["'']([^"'']*)["'']"""


def _unescaped(text: str) -> str:
    for entity, char in D.ENTITIES:
        text = f"replace({text}, '{entity}', '{char.replace(chr(39), chr(39) * 2)}')"
    return text


@query(
    "extract_links",
    f"""WITH a AS (SELECT page_id, regexp_extract_all(html, '{_TAG}') AS found FROM pages),
    e AS (SELECT page_id, unnest(found) AS element, generate_subscripts(found, 1) - 1 AS pos FROM a),
    o AS (SELECT *, regexp_extract(element, '(?is)^<[^>]*>') AS opening FROM e)
    SELECT page_id, pos, CASE WHEN regexp_matches(opening, '{_HREF}')
             THEN {_unescaped(f"regexp_extract(opening, '{_HREF}', 1)")} END AS href,
      NULL AS data_oid, NULL AS data_otype, NULL AS title,
      {_unescaped("regexp_replace(element, '<[^>]*>', '', 'g')")} AS text FROM o""",
)
def extract_links(t):
    return D.extract_links(t.pages, "page_id", "html")


@query(
    "zero_refs",
    f"""WITH {X.ARTICLES}
    SELECT a.id, a.title, '<p>See' || chr(10) || ' <a class="m" data-otype="' || otype || '" data-oid="0" title="'
      || (CASE WHEN otype = 'article' AND t.id IS NOT NULL THEN t.title || '">' || t.title
          ELSE 'link &amp; ' || ref || '">link &amp; <b>' || ref || '</b>' END)
      || '</a>, or <a href="/home">home</a>; <a data-otype="article" data-oid="0" title="Order ' || o_orderkey
      || '">Order ' || o_orderkey || '</a>  </p>' AS body
    FROM art a LEFT JOIN (SELECT id, title FROM art) t ON t.id = a.o_custkey""".replace(
        "THEN t.title || '\">' || t.title\n          ELSE 'link &amp; ' || ref || '\">link &amp; <b>' || ref || '</b>' END)",
        "THEN t.title || '\">' || t.title\n          WHEN otype = 'article' THEN 'link &amp; ' || ref || '\">link &amp; ' || ref\n"
        "          ELSE 'link &amp; ' || ref || '\">link &amp; <b>' || ref || '</b>' END)",
    ),
)
def zero_refs(t):
    articles = X.articles(t)
    return D.zero_refs(articles, articles)


_SECOND = """'</b></a>, or <a href="/home">home</a>; <a data-otype="article" data-oid="' || second_oid
      || '" href="/article/' || second_oid || '/">' || n_name || '</a>  </p>'"""
_TITLE = """' title="' || ref || '">link &amp; <b>' || ref || """


@query(
    "rewrite_refs",
    f"""WITH {X.ARTICLES}, {X.REFERENCE_IDS}
    SELECT id, title, '<p>See' || chr(10) || ' <a class="m" data-o' ||
      (CASE WHEN oid IS NULL THEN 'id="' || o_custkey || '" data-otype="' || otype || '" href="/old/' || id || '/"'
       ELSE 'type="' || otype || '" data-oid="' || oid || '" href="/' || otype || '/' || oid || '/"' END)
      || {_TITLE} {_SECOND} AS body FROM refs""",
)
def rewrite_refs(t):
    return D.rewrite_refs(X.articles(t), X.reference_dims(t))


@query(
    "rewrite_refs_zero",
    f"""WITH {X.ARTICLES}, {X.REFERENCE_IDS}
    SELECT id, title, '<p>See' || chr(10) || ' <a class="m" data-otype="' || otype || '" data-oid="' ||
      (CASE WHEN oid IS NULL THEN '0"' ELSE oid || '" href="/' || otype || '/' || oid || '/"' END)
      || {_TITLE} {_SECOND} AS body FROM refs""",
)
def rewrite_refs_zero(t):
    return D.rewrite_refs(X.articles(t), X.reference_dims(t), on_missing="zero")


@query(
    "broken_refs",
    f"""WITH {X.ARTICLES}, {X.REFERENCE_IDS}
    SELECT id, otype, count(*) AS broken FROM refs WHERE oid IS NULL GROUP BY 1, 2""",
)
def broken_refs(t):
    return D.broken_refs(X.articles(t), X.reference_dims(t))


@query(
    "strip_internal_links",
    f"""WITH {X.ARTICLES}
    SELECT id, '<p>See' || chr(10) || ' <a class="m" data-oid="' || o_custkey || '" data-otype="' || otype
      || '" href="/old/' || id || '/" title="' || ref || '">link &amp; <b>' || ref || '</b></a>'
      || ', or <a href="/home">home</a>; ' || n_name || '  </p>' AS body FROM art""",
)
def strip_internal_links(t):
    return D.strip_internal_links(X.articles(t).select("id", "body"), "body")


@query(
    "media_files",
    """SELECT page_id, '/media/image_bank/p' || page_id || '.png' AS src, 'p' || page_id || '.png' AS name,
       doc_id IS NOT NULL AS stored FROM pages LEFT JOIN labels ON page_id = doc_id""",
)
def media_files(t):
    name = lambda c: F.concat(F.lit("p"), F.col(c).cast("string"), F.lit(".png"))
    pages = t.pages.select(
        "page_id",
        F.concat("html", F.lit('<IMG alt="x" src="/media/image_bank/'), name("page_id"), F.lit('"/>')).alias("html"),
    )
    stored = t.labels.select(name("doc_id").alias("name"))
    return D.media_files(pages, stored, "page_id", "html")


@query(
    "entity_filter",
    """SELECT doc_id, CASE WHEN source = lang THEN lang ELSE array_to_string(list_sort([lang, source]), ' ') END AS ent
       FROM documents""",
)
def entity_filter(t):
    entity = lambda c, label: F.struct(
        F.col(c).alias("entity_text"), F.lit(label).alias("entity_label")
    )
    posts = t.documents.select(
        "doc_id",
        F.array(
            entity("lang", "NORP"), entity("source", "ORG"), entity("text", "DATE"), entity("lang", "GPE")
        ).alias("entities"),
    )
    found = D.entity_filter(posts)
    return found.select("doc_id", F.array_join(F.array_sort("ent"), " ").alias("ent"))


@query(
    "article_contributors",
    """SELECT o_custkey AS id, 'author' || o_custkey AS name FROM orders
       UNION SELECT o_custkey + 1, 'author' || (o_custkey + 1) FROM orders""",
)
def article_contributors(t):
    person = lambda c: F.struct(
        c.alias("id"), F.concat(F.lit("author"), c.cast("string")).alias("name")
    )
    rows = t.orders.select(
        person(F.col("o_custkey")).alias("author"),
        F.array(person(F.col("o_custkey") + 1), person(F.col("o_custkey"))).alias("editors"),
    )
    return D.article_contributors(rows)


@query(
    "row_articles",
    """SELECT 'DTV-' || p_name || '-' || p_brand || '-' || p_partkey AS key, '<table><tbody><tr><td> p_name </td><td> '
      || p_name || ' </td></tr>' || chr(10) || '<tr><td> p_brand </td><td> ' || p_brand || ' </td></tr>'
      || (CASE WHEN p_size > 25 THEN chr(10) || '<tr><td> size </td><td> ' || p_size || ' </td></tr>' ELSE '' END)
      || '</tbody></table>' AS description, p_brand AS "DTVp_brand" FROM part""",
)
def row_articles(t):
    rows = t.part.select(
        "p_partkey", "p_name", "p_brand", F.when(F.col("p_size") > 25, F.col("p_size")).alias("size")
    )
    return D.row_articles(rows, ["p_name", "p_brand"], "p_partkey", "DTV", ["p_brand"])


@query(
    "article_to_term",
    """SELECT doc_id AS id, source AS title, text AS description, CASE lang WHEN 'en' THEN 47 ELSE 48 END AS template_id,
       CASE lang WHEN 'en' THEN 3 ELSE 4 END AS glossary_id FROM documents WHERE lang IN ('en', 'fr')""",
)
def article_to_term(t):
    articles = t.documents.select(
        F.col("doc_id").alias("id"), F.col("source").alias("title"), F.col("text").alias("body"),
        F.array("lang", F.lit("other")).alias("templates"),
    )
    return D.article_to_term(articles, {"en": (47, 3), "fr": (48, 4)})
