"""Table references in SQL texts, found with regular expressions over a log table.

Covered: INSERT INTO ... SELECT, COPY ... FROM, FROM and JOIN at any nesting depth, comma lists
(also around subqueries), quoted names with blanks, comments, quoted texts, and names defined by
WITH (left out). Not covered: targets of CREATE TABLE AS or MERGE, and quoted names that hold a
bracket or a key word of SQL.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmark.functions.html import mention_link
from shelfmark.functions.keys import hash_id
from shelfmark.functions.text import regex_extract
from shelfmark.operators.rebuild import replace_resolved
from shelfmark.skew import lookup_join

# quoted texts are matched first, so that comment marks inside them do not count
_COMMENT = r"""('[^']*'|"[^"]*")|--[^\n]*|/\*[\s\S]*?\*/"""
_PIECE = r"""'[^']*'|"[^"]*"|;|[^'";]+|['"]"""
_CUT = "\u0001"


def without_comments(sql: str | Column) -> Column:
    return F.regexp_replace(F.col(sql) if isinstance(sql, str) else sql, _COMMENT, "$1")


def split_statements(df: DataFrame, text: str) -> DataFrame:
    """One row per statement with its place; comments and empty statements are dropped."""
    pieces = F.regexp_extract_all(without_comments(text), F.lit(_PIECE), F.lit(0))
    marked = F.array_join(
        F.transform(pieces, lambda p: F.when(p == ";", F.lit(_CUT)).otherwise(p)), ""
    )
    trimmed = F.transform(
        F.split(marked, _CUT), lambda s: F.regexp_replace(s, r"^\s+|\s+$", "")
    )
    statements = F.filter(trimmed, lambda s: s != "")
    return df.select("*", F.posexplode(statements).alias("statement_no", "statement"))


_BRACKET = r"\(([^()]*)\)"
_HOLE = "\u0002"
_CTE = r"(?i)(?:\bwith|\brecursive|,)\s+(\w+)\s+as\s*\("
_QUERY = r"(?i)^\s*(?:select|with|insert|delete|update|create|merge|copy|from)\b"
# what FROM introduces, up to the next clause
_CLAUSE = (
    r"(?is)\bfrom\b(.*?)(?=\b(?:where|group|order|having|limit|union|intersect|except|minus"
    r"|window|qualify|select|from|set|values|returning)\b|;|$)"
)
_BETWEEN = r"(?i),|\b(?:(?:natural|inner|cross|left|right|full|outer|semi|anti)\s+)*join\b"
_WORD = r"""(?:"[^"]+"|`[^`]+`|\[[^\]]+\]|[^\s,;()"`\[\].\x02]+)"""
_NAME = rf"({_WORD}(?:\s*\.\s*{_WORD})*)"


def _bare(name: Column) -> Column:
    """A name without identifier quotes, and without blanks around its dots."""
    return F.translate(F.regexp_replace(name, r"\s*\.\s*", "."), '"`[]', "")


def _masked(statement: str) -> Column:
    no_text = F.regexp_replace(without_comments(statement), r"'[^']*'", "''")
    return F.regexp_replace(no_text, r"(?i)\bis\s+(?:not\s+)?distinct\s+from\b", "=")


def _flat_parts(text: Column) -> Column:
    """What stands in each pair of brackets, and outside of all, with a mark for inner brackets.

    Every step takes out the innermost brackets, so there are as many steps as brackets are
    nested; further ones see no bracket and do nothing.
    """

    def step(state: Column, _: Column) -> Column:
        inner = F.regexp_extract_all(state["text"], F.lit(_BRACKET), F.lit(1))
        taken = F.struct(
            F.regexp_replace(state["text"], _BRACKET, f" {_HOLE} ").alias("text"),
            F.concat(state["parts"], inner).alias("parts"),
        )
        return F.when(F.contains(state["text"], F.lit("(")), taken).otherwise(state)

    start = F.struct(text.alias("text"), F.array().cast("array<string>").alias("parts"))
    opened = F.length(text) - F.length(F.replace(text, F.lit("("), F.lit("")))
    return F.aggregate(
        F.sequence(F.lit(0), opened),
        start,
        step,
        lambda end: F.concat(F.array(F.concat(F.lit("select "), end["text"])), end["parts"]),
    )


def _listed(clause: Column) -> Column:
    """First names of the items of a FROM clause."""
    return F.transform(
        F.split(clause, _BETWEEN),
        lambda item: _bare(F.regexp_extract(item, r"(?i)^\s*(?:(?:only|lateral)\s+)?" + _NAME, 1)),
    )


def with_table_references(df: DataFrame, statement: str) -> DataFrame:
    """Add the distinct ``sources`` and ``targets`` named in a statement, as arrays.

    Brackets that hold no query, as in ``extract(year FROM d)``, name no table unless they group
    a join. The steps are columns of their own so that each is evaluated once per statement.
    """
    clauses = F.flatten(
        F.transform(
            "_parts",
            lambda p: F.when(
                F.rlike(p, F.lit(_QUERY)), F.regexp_extract_all(p, F.lit(_CLAUSE), F.lit(1))
            )
            .when(F.rlike(p, F.lit(r"(?i)\bjoin\b")), F.array(p))
            .otherwise(F.array().cast("array<string>")),
        )
    )
    into = F.lit(r"(?i)\binsert\s+into\s+(?:table\s+)?" + _NAME)
    cut = (
        df.withColumn("_masked", _masked(statement))
        .withColumn("_parts", _flat_parts(F.col("_masked")))
        .withColumn("_clauses", clauses)
        .withColumn("_names", F.flatten(F.transform("_clauses", _listed)))
        .withColumn("_defined", F.transform(regex_extract("_masked", _CTE, 1), lambda n: F.lower(n)))
        .withColumn("_into", F.transform(F.regexp_extract_all("_masked", into, F.lit(1)), _bare))
    )
    sources = F.filter(
        "_names", lambda name: (name != "") & ~F.array_contains("_defined", F.lower(name))
    )
    return (
        cut.withColumn("sources", F.array_distinct(sources))
        .withColumn("targets", F.array_distinct("_into"))
        .drop("_masked", "_parts", "_clauses", "_names", "_defined", "_into")
    )


_COPY = r"(?is)^\s*copy\s+([^\s(]+)[\s\S]*?\sfrom\s+('[^']*'|[^\s;]+)"


def _ends(names: Column, otype: Column) -> Column:
    return F.transform(
        names,
        lambda n: F.struct(otype.alias("otype"), n.alias("key"), F.lit(False).alias("is_temp")),
    )


def _path(sources: Column, source_type: Column, flow: str, targets: Column) -> Column:
    return F.array(
        _ends(sources, source_type),
        _ends(F.array(flow), F.lit("dataflow")),
        _ends(targets, F.lit("table")),
    )


def sql_table_lineage(stmts: DataFrame, statement: str = "statement") -> DataFrame:
    """Lineage path per statement that moves data between tables, or from a file to a table.

    The dataflow id is a hash of the statement's text, so the same text gives one dataflow and
    is read once; statements without a source or without a target are left out. Feed the
    result to ``lineage_edges``.
    """
    texts = stmts.select(F.col(statement).alias("content")).distinct()
    found = with_table_references(texts, "content").withColumn(
        "_from_file", F.regexp_extract("content", _COPY, 2)
    )
    is_copy = F.col("_from_file") != ""
    copied = F.translate(F.regexp_extract("content", _COPY, 1), '"`[]', "")
    ends = F.struct(
        F.when(is_copy, F.lit("file")).otherwise(F.lit("table")).alias("kind"),
        F.when(is_copy, F.array(F.translate("_from_file", "'", "")))
        .otherwise(F.col("sources"))
        .alias("sources"),
        F.when(is_copy, F.array(copied)).otherwise(F.col("targets")).alias("targets"),
    )
    complete = is_copy | ((F.size("sources") > 0) & (F.size("targets") > 0))
    # a list of one or none instead of a filter, which would evaluate the names twice
    kept = found.select(
        "content",
        F.concat(F.lit("api/"), hash_id("content", "sha224", 16)).alias("dataflow"),
        F.explode(F.when(complete, F.array(ends))).alias("e"),
    )
    return kept.select(
        "dataflow",
        "content",
        _path(F.col("e.sources"), F.col("e.kind"), "dataflow", F.col("e.targets")).alias("path"),
    )


_PART = r"""("[^"]*"|`[^`]*`|\[[^\]]*\]|[^\s."`\[\]]+)"""
_DOT = "\u0003"  # between the parts of a name, of which a quoted one may hold dots


def name_parts(name: str | Column) -> Column:
    """Parts of a dotted name in lower case, without identifier quotes."""
    found = F.regexp_extract_all(F.col(name) if isinstance(name, str) else name, F.lit(_PART), F.lit(1))
    bare = lambda part: F.regexp_replace(part, r"""^["`\[](.*)["`\]]$""", "$1")
    return F.transform(found, lambda part: F.lower(bare(part)))


def _tails(parts: Column, least: int) -> Column:
    """The last parts of a name, all of them first, down to the last ``least``."""
    n = F.size(parts)
    starts = F.when(n >= least, F.sequence(F.lit(1), n - least + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.array_join(F.slice(parts, i, n), _DOT))


def tail_index(catalog: DataFrame) -> DataFrame:
    """(tail, key, rank): every name under which a catalog table may be met, with its lowest key.

    ``catalog`` has (``schema``, ``table``, ``key``), the schema of any number of parts. Names are the
    table's whole name (rank 0) and its other dotted tails (1), and each other part of the schema
    with the table (2). Of several tables for one name the lowest rank counts, then the lowest key.
    """
    schema = F.coalesce(name_parts("schema"), F.array().cast("array<string>"))
    table = F.lower(F.regexp_replace("table", r"""^["`\[](.*)["`\]]$""", "$1"))
    named = catalog.where("table is not null").select("key", schema.alias("schema"), table.alias("table"))
    whole = F.concat("schema", F.array("table"))
    entries = F.concat(
        F.transform(_tails(whole, 1), lambda t, i: F.struct(t.alias("tail"), F.least(i, F.lit(1)).alias("rank"))),
        F.transform("schema", lambda s: F.struct(F.concat_ws(_DOT, s, "table").alias("tail"), F.lit(2).alias("rank"))),
    )
    best = F.min(F.struct("rank", "key"))
    return (
        named.select("key", F.explode(entries).alias("e")).select("key", "e.*")
        .groupBy("tail").agg(best.alias("b")).select("tail", "b.key", "b.rank")
    )


def resolve_tables(refs: DataFrame, catalog: DataFrame, name: str = "name") -> DataFrame:
    """Add the catalog key of a table name in a text, null if there is none.

    Names have any number of parts, quoted or not; case is ignored. The whole name is looked up
    among the names of ``tail_index``. A name that has more parts than the catalog knows, as one with a
    database in front, is then tried without its first parts, down to schema and table, against
    whole names of the catalog only. The first that is found counts, of several tables the lowest
    key among those of the best rank.

    Distinct names are split and looked up once; rows of ``refs`` are joined with the result.
    """
    names = refs.select(F.col(name).alias("_name")).where("_name is not null").distinct()
    parts = names.select("_name", name_parts("_name").alias("parts"))
    # the whole name even if it has one part, then its tails of two parts and more
    shorter = F.when(F.size("parts") > 2, F.slice(_tails(F.col("parts"), 2), 2, 1 << 30)).otherwise(F.array().cast("array<string>"))
    probes = F.concat(F.array(F.array_join("parts", _DOT)), shorter)
    probed = parts.select("_name", F.posexplode(probes).alias("step", "tail"))
    index = tail_index(catalog)
    found = (
        lookup_join(probed, index, "tail", "inner")
        .where("step = 0 or rank = 0")
        .groupBy("_name")
        .agg(F.min_by("key", "step").alias("key"))
    )
    return lookup_join(refs.withColumn("_name", F.col(name)), found, "_name").drop("_name")


_MENTION = r"([A-Z0-9_]+)\.([A-Z0-9_]+)"


def mention_resolve(
    df: DataFrame, row_id: str, text: str, columns: DataFrame, pattern: str = _MENTION
) -> DataFrame:
    """Turn TABLE.COLUMN mentions of known columns into links.

    ``columns`` has (``table``, ``column``, ``id``); case is ignored, the lowest id counts.
    """
    dim = columns.groupBy(F.lower(F.concat("table", F.lit("."), "column")).alias("_key")).agg(
        F.min("id").cast("string").alias("_oid")
    )

    def parse(found: Column) -> Column:
        return F.transform(found, lambda m: F.struct(m.alias("mention"), F.lower(m).alias("key")))

    def build(m: Column, oid: Column) -> Column:
        link = F.concat(F.lit("<p>"), mention_link("attribute", oid, m["mention"]), F.lit("</p>"))
        return F.when(oid.isNull(), m["mention"]).otherwise(link)

    return replace_resolved(
        df, row_id, text, pattern, F.col(text).rlike(pattern), parse, dim, "_key", "_oid", build
    )


_TABLE_REF = rf"(?i)\b(from|join)\b[\s(]*{_NAME}"


def text_dictionary_match(
    log: DataFrame, row_id: str, text: str, catalog: DataFrame
) -> DataFrame:
    """Catalog tables named after FROM or JOIN in a text: (row id, ``pos``, ``statement``, ``schema``,
    ``table``, ``key``), with schema and table as the text has them, in lower case and without quotes.

    Names have one to many parts, quoted or not, and are resolved as by ``resolve_tables``. All are
    extracted first and then joined, so the cost follows the texts and not the number of catalog
    tables.
    """
    hits = F.regexp_extract_all(text, F.lit(_TABLE_REF), F.lit(0))
    group = lambda i: F.regexp_extract("hit", _TABLE_REF, i)
    refs = log.select(row_id, F.posexplode(hits).alias("pos", "hit")).select(
        row_id, "pos", F.lower(group(1)).alias("statement"), group(2).alias("_ref")
    )
    parts = name_parts("_ref")
    return resolve_tables(refs, catalog, "_ref").where("key is not null").select(
        row_id,
        "pos",
        "statement",
        F.array_join(F.slice(parts, F.lit(1), F.size(parts) - 1), ".").alias("schema"),
        F.element_at(parts, -1).alias("table"),
        "key",
    )


def pipeline_lineage(pipelines: DataFrame) -> DataFrame:
    """Lineage path of each pipeline from the tables of its query to its target."""
    flow = F.concat(F.lit("api/"), hash_id(F.concat_ws(">", "query", "target"), "sha224", 16))
    found = with_table_references(pipelines, "query").select(
        flow.alias("dataflow"),
        F.col("query").alias("content"),
        "target",
        F.explode(F.when(F.size("sources") > 0, F.array("sources"))).alias("s"),
    )
    return found.select(
        "dataflow",
        "content",
        _path(F.col("s"), F.lit("table"), "dataflow", F.array("target")).alias("path"),
    )
