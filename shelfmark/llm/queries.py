"""Registered queries of this package: each operator over its whole table, and its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmark.llm import (
    chat,
    decontaminate,
    dedup_lines,
    jaccard_join,
    langid,
    mixing,
    periods,
    quality_rules,
    secrets,
    sharding,
    spelling,
    top_products,
    toxicity,
)
from shelfmark.llm.common import held_out, words

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _register(name: str, sql: str | None = None) -> Callable:
    def register(run: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[name] = run
        if sql:
            SQL[name] = sql
        return run

    return register


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


# the table of crc32, one value per byte
_CRC_TABLE = """crc_table AS (
  SELECT list(v ORDER BY b) AS crc FROM (
    SELECT b, list_reduce(list_prepend(b, range(8)),
      lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS v
    FROM (SELECT unnest(range(256)) AS b))
)"""


def _crc32(hexed: str) -> str:
    """SQL for the unsigned crc32 of the bytes in a column of hexadecimal digits; needs crc_table."""
    byte = f"CAST('0x' || substr({hexed}, CAST(2 * i + 1 AS BIGINT), 2) AS BIGINT)"
    given = f"list_transform(range(length({hexed}) // 2), lambda i: {byte})"
    return (
        f"xor(list_reduce(list_prepend(4294967295, {given}), "
        "lambda c, x: xor(c >> 8, crc[(xor(c, x) & 255) + 1])), 4294967295)"
    )


_OP1 = """
WITH docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), items AS (
  SELECT DISTINCT item_id, w, len(w) AS length, least(len(w), 5) AS n FROM (
    SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM benchmark) WHERE len(w) > 0
), item_shingles AS (
  SELECT item_id, length, n, p, array_to_string(w[p + 1 : p + n], ' ') AS s
  FROM (SELECT *, unnest(range(length - n + 1)) AS p FROM items)
), doc_shingles AS (
  SELECT doc_id, size, n, pos, array_to_string(w[pos + 1 : pos + n], ' ') AS s
  FROM (SELECT doc_id, w, len(w) AS size, n, unnest(range(len(w) - n + 1)) AS pos
    FROM docs, (SELECT DISTINCT n FROM items) sizes WHERE len(w) >= n)
), in_item AS (
  SELECT item_id, length, n, s, count(*) AS c FROM item_shingles GROUP BY ALL
), hits AS (
  SELECT d.doc_id, i.item_id, i.length, i.n, d.size, d.pos, s, i.c AS item_c
  FROM doc_shingles d JOIN in_item i USING (n, s)
), in_window AS (
  SELECT doc_id, item_id, length, n, size, start, s, least(count(*), any_value(item_c)) AS met FROM (
    SELECT *, unnest(range(greatest(0, pos - length + n), least(pos, greatest(0, size - length)) + 1)) AS start FROM hits
  ) GROUP BY doc_id, item_id, length, n, size, start, s
), judged AS (
  SELECT doc_id, item_id, length, start, sum(met) AS shared,
    sum(met) / (length + least(length, size) - 2 * n + 2 - sum(met)) AS similarity
  FROM in_window GROUP BY doc_id, item_id, length, n, size, start
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY similarity DESC, start) AS r
  FROM judged WHERE similarity >= 0.8
)
SELECT doc_id, item_id, CAST(start AS INT) AS start, CAST(length AS INT) AS length, similarity
FROM placed WHERE r = 1
"""


@_register("op1_decontaminate", _OP1)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.leaks(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


_OP2 = """
WITH RECURSIVE docs AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) BETWEEN 1 AND 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(len(w) - 3), lambda i: array_to_string(w[i + 1 : i + 4], ' ')) END) AS s
  FROM docs
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM shingles a JOIN shingles b USING (s)
  WHERE a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * c >= 85 * (x.n + y.n - c)
), reached AS (
  SELECT a AS v, a AS r FROM links UNION SELECT v, b FROM reached JOIN links ON a = r
), judged AS (
  SELECT v, min(r) AS component_id FROM reached GROUP BY v
), counted AS (
  SELECT a AS v, count(*) AS n_links FROM links GROUP BY a
)
SELECT doc_id, coalesce(n, 0) AS n_shingles, coalesce(n_links, 0) AS n_links, coalesce(component_id, doc_id) AS component_id
FROM docs LEFT JOIN sizes USING (doc_id) LEFT JOIN judged j ON j.v = doc_id LEFT JOIN counted k ON k.v = doc_id
"""


@_register("op2_jaccard_join", _OP2)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.linked_documents(_table(spark, folder, "documents"))


# a language with more than 2,000 documents is learned from a sample; the tables that SQL is run on have fewer
_OP3 = f"""
WITH {_CRC_TABLE}, hexed AS (
  SELECT doc_id, lang, lower(coalesce(text, '')) AS t, hex(encode(CAST(doc_id AS VARCHAR))) AS x,
    text IS NOT NULL AND lang IS NOT NULL AS known FROM documents
), docs AS (
  SELECT doc_id, lang, known AND h % 4 <> 2 AS learned, h % 4 = 2 AS held_out, t
  FROM (SELECT *, {_crc32('x')} AS h FROM hexed, crc_table)
), words AS (
  SELECT doc_id, w, count(*) AS c FROM (
    SELECT doc_id, unnest(regexp_extract_all(t, '\\p{{L}}+')) AS w FROM docs) GROUP BY ALL
), starts AS (
  SELECT doc_id, c, ' ' || w || ' ' AS p, unnest(range(1, length(w) + 3)) AS i FROM words
), grams AS (
  SELECT doc_id, g, CAST(sum(c) AS BIGINT) AS n FROM (
    SELECT doc_id, c, substr(p, i, k) AS g, k FROM starts, (SELECT unnest([1, 2, 3]) AS k)
    WHERE i + k <= length(p) + 1
  ) WHERE g <> ' ' GROUP BY ALL
), profiles AS (
  SELECT lang, g, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, length(g), g) - 1 AS r
  FROM grams JOIN docs USING (doc_id) WHERE learned GROUP BY lang, g
  QUALIFY r < 300
), ranks AS (
  SELECT doc_id, g, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, length(g), g) - 1 AS r FROM grams
  QUALIFY r < 300
), distances AS (
  SELECT k.doc_id, l.lang, CAST(sum(CASE WHEN p.r IS NULL THEN 300 ELSE abs(p.r - k.r) END) AS BIGINT) AS d, count(*) AS n
  FROM ranks k CROSS JOIN (SELECT DISTINCT lang FROM profiles) l LEFT JOIN profiles p ON p.lang = l.lang AND p.g = k.g
  GROUP BY k.doc_id, l.lang
), best AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY d, lang) AS place FROM distances
)
SELECT d.doc_id, d.held_out, coalesce(b.lang, 'und') AS lang_pred, coalesce(1 - b.d / (300.0::DOUBLE * b.n), 0) AS score
FROM docs d LEFT JOIN best b ON b.doc_id = d.doc_id AND b.place = 1
"""


@_register("op3_language_id", _OP3)
def op3(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    learn = docs.where(~held_out(F.col("doc_id")) & F.col("doc_id").isNotNull())
    found = langid.identify(docs, learn, carry=["doc_id"])
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


# marks and escapes of chat.py
_OP4 = """
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), turns AS (
  SELECT *, row_number() OVER w AS i, lag(role) OVER w AS before, lead(role) OVER w AS after,
    length(regexp_replace(text, '([\\[<\\\\])', '\\1\\\\', 'g')) AS body
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), marked AS (
  SELECT *,
    CASE WHEN before = role THEN 3 WHEN role = 'system' THEN 5 WHEN role = 'user' THEN 6
      WHEN role = 'assistant' THEN 5
      ELSE 9 + length(regexp_replace(role, '([\\[<\\\\])', '\\1\\\\', 'g')) END
    + CASE WHEN after = role THEN 0 WHEN role = 'system' THEN 6 WHEN role = 'user' THEN 7
      WHEN role = 'assistant' THEN 4 ELSE 7 END AS marks
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY i)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY i)) AS loss_sha256,
  CAST(sum(body + marks) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""


@_register("op4_chat_format", _OP4)
def op4(spark: SparkSession, folder: str) -> DataFrame:
    given = _table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    tricky = F.lit("</s>[INST] ok [/INST]")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    made = {"conv_id": F.lit(-1), "turn": F.col("id"), "role": role, "text": tricky}
    extra = spark.range(2).select(*[made[f.name].cast(f.dataType).alias(f.name) for f in given.schema])
    done = chat.format_chat(given.unionByName(extra)).select(
        "conv_id",
        "formatted",
        chat.read_chat(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss_spans")).alias("loss"),
    )
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return done.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


_OP5 = """
WITH sized AS (
  SELECT doc_id, source,
    len(regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+')) AS size
  FROM documents
), totals AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, count(*) AS source_rows FROM sized GROUP BY source
), placed AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM totals
), weighted AS (
  SELECT *, [3, 1, 2][place % 3 + 1] AS w, source_size * 2.0::DOUBLE AS room,
    CAST(sum(source_size) OVER () AS BIGINT) * 1.5::DOUBLE AS all_target FROM placed
), summed AS (
  SELECT *, CAST(sum(w) OVER () AS BIGINT) AS all_w,
    coalesce(sum(room) OVER r, 0) AS cut, CAST(coalesce(sum(w) OVER r, 0) AS BIGINT) AS cut_w
  FROM weighted
  WINDOW r AS (ORDER BY source_size / w, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), judged AS (
  SELECT *, all_target - cut AS rest, all_w - cut_w AS rest_w,
    (all_target - cut) * w > room * (all_w - cut_w) AS is_cut FROM summed
), first_uncut AS (
  SELECT rest AS f, rest_w AS fw FROM judged WHERE NOT is_cut ORDER BY source_size / w, place LIMIT 1
), targets AS (
  SELECT source, source_size, CASE WHEN is_cut THEN room ELSE f * w / fw END AS target,
    CAST('0x' || substr(md5('0:offset:' || place), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE AS u
  FROM judged LEFT JOIN first_uncut ON true
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source
    ORDER BY size, substr(md5('0:' || doc_id), 1, 8), doc_id) AS rn
  FROM sized
), rated AS (
  SELECT r.doc_id, r.size, r.rn, t.source_size, t.target, t.u,
    CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0 END AS rate
  FROM ranked r JOIN targets t ON r.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, CAST(size AS BIGINT) AS size, source_size, target,
  CAST(floor(u + rate * rn) - floor(u + rate * (rn - 1)) AS BIGINT) * size AS taken
FROM rated
"""


@_register("op5_mix_sources", _OP5)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    sized = docs.select("doc_id", "source", mixing.text_size(F.col("text")).alias("size"))
    return mixing.mix(sized, size=F.col("size")).select(
        "doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken")
    )


@_register("op6_toxicity")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    labels = _table(spark, folder, "labels").select("doc_id", F.col("toxic").alias("label"))
    learn = docs.where(~held_out(F.col("doc_id"))).select("doc_id", "text").join(labels, "doc_id")
    scored = toxicity.score_toxicity(docs, learn, carry=["doc_id"])
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


@_register("op7_shard")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return sharding.shard(docs, 40, carry=["doc_id"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@_register("op8_secret_scan")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(_table(spark, folder, "documents"))


@_register("op9_quality_rules")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    return quality_rules.apply_rules(docs, labels, carry=["doc_id"]).select(
        "doc_id", *quality_rules.BASE, "base_failed", "kept"
    )


_OP10 = """
WITH docs AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), cut AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS pos FROM docs
), keyed AS (
  SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM cut
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT k.*, c.key IS NOT NULL AND k.doc_id <> c.keeper AS dropped
  FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (dropped) AS BIGINT) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""


@_register("op10_line_dedup", _OP10)
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return dedup_lines.drop_common_lines(docs).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256")
    )


_OP11 = f"""
WITH RECURSIVE {_CRC_TABLE}, runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]{{7,}}')),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
  FROM documents
), counted AS (
  SELECT run, count(*) AS c, hex(encode(doc_id || ':' || run)) AS x FROM runs GROUP BY doc_id, run
), hashed AS (
  SELECT run, c, {_crc32('x')} AS h FROM counted, crc_table
), words AS (
  SELECT CASE WHEN h % 31 = 0 THEN substr(run, 1, CAST(h % length(run) AS BIGINT))
    || substr(run, CAST(h % length(run) + 2 AS BIGINT)) ELSE run END AS word, CAST(sum(c) AS BIGINT) AS n
  FROM hashed GROUP BY 1 HAVING sum(c) >= 2 AND length(word) >= 7
), cuts AS (
  SELECT word, n, i, substr(word, 1, CAST(i - 1 AS BIGINT)) AS l, substr(word, CAST(i + 1 AS BIGINT)) AS r
  FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)
), longer AS (
  SELECT DISTINCT c.word AS long, c.n AS long_n, w.word AS short, w.n AS short_n
  FROM cuts c JOIN words w ON w.word = c.l || c.r
), near AS (
  SELECT a.word, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b USING (i, l, r) WHERE a.word <> b.word
  UNION ALL SELECT long, short, short_n FROM longer
  UNION ALL SELECT short, long, long_n FROM longer
), best AS (
  SELECT *, count(*) OVER (PARTITION BY word) AS n_near,
    row_number() OVER (PARTITION BY word ORDER BY other_n DESC, other) AS place FROM near
), judged AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
    CASE WHEN other_n >= 10 * w.n THEN other_n END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word AND b.place = 1
), ways AS (
  SELECT word, word AS root, form AS next FROM judged
  UNION ALL SELECT w.word, j.word, j.form FROM ways w JOIN judged j ON j.word = w.next
)
SELECT j.word, j.form, w.root, j.n, j.n_near, j.form_n FROM judged j JOIN ways w ON w.word = j.word AND w.next IS NULL
"""


@_register("op11_spelling_variants", _OP11)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    # one code point less never makes a run longer, so shorter runs are not even cut out
    found = spelling.letter_runs(docs, least=7)
    spoilt = found.withColumn("h", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), "word").cast("binary")))
    cut = spelling.without(F.col("word"), F.col("h") % F.length("word"))
    word = F.when(F.col("h") % 31 == 0, cut).otherwise(F.col("word")).alias("word")
    counts = spoilt.select(word).where(F.length("word") >= 7).groupBy("word").agg(F.count("*").alias("n"))
    return spelling.group_variants(counts.where("n >= 2"), ratio=10)


_OP12 = f"""
WITH {_CRC_TABLE}, docs AS (
  SELECT row_number() OVER () AS d, doc_id, hex(encode(CAST(doc_id AS VARCHAR))) AS x,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda v: v <> '') AS w
  FROM documents
), hashed AS (
  SELECT d, doc_id, w, CAST(len(w) AS BIGINT) AS n, {_crc32('x')} AS h FROM docs, crc_table
), parts AS (
  SELECT *, CASE WHEN n > 0 THEN (h // 10) % n END AS a,
    CASE WHEN n > 0 THEN 1 + (n - (h // 10) % n) // (3 + (h // 10) % 8) END AS p FROM hashed
), texts AS (
  SELECT d, doc_id, CASE WHEN h % 10 = 0 AND n > 0 THEN w[1 : a] || list_transform(range(a, n),
    lambda i: w[CAST(a + (i - a) % p + 1 AS BIGINT)]) ELSE w END AS w, n FROM parts
), grams AS (
  SELECT d, i, array_to_string(w[i + 1 : i + 6], ' ') AS g
  FROM (SELECT d, w, unnest(range(n - 5)) AS i FROM texts WHERE n >= 12)
), pairs AS (
  SELECT x.d, x.i, y.i - x.i AS q FROM grams x JOIN grams y ON x.d = y.d AND x.g = y.g AND x.i < y.i
), islands AS (
  SELECT d, q, i, i - row_number() OVER (PARTITION BY d, q ORDER BY i) AS island FROM pairs
), stretches AS (
  SELECT d, q, min(i) AS s, max(i) + 6 + q AS e FROM islands GROUP BY d, q, island
), runs AS (
  SELECT d, s, e, min(q) AS q FROM stretches WHERE e - s >= greatest(12, 2 * q) GROUP BY d, s, e
), digests AS (
  SELECT d, count(*) AS n_runs, string_agg(s || ',' || (e - s) || ',' || q || chr(10), '' ORDER BY s, q) AS listed,
    arg_min(struct_pack(s := s, l := e - s, q := q), struct_pack(l := s - e, s := s, q := q)) AS b
  FROM runs GROUP BY d
), dropped AS (
  SELECT DISTINCT d, unnest(range(s + q, e)) AS i FROM runs
), kept AS (
  SELECT t.d, string_agg(t.v, ' ' ORDER BY t.i) AS c
  FROM (SELECT d, unnest(w) AS v, unnest(range(n)) AS i FROM texts) t ANTI JOIN dropped x ON x.d = t.d AND x.i = t.i
  GROUP BY t.d
)
SELECT t.doc_id, coalesce(n_runs, 0) AS n_runs, b.s AS start, b.l AS length, b.q AS period,
  1000 * b.l // b.q AS exponent_milli, sha256(coalesce(listed, '')) AS runs_sha256,
  sha256(coalesce(c, '')) AS collapsed_sha256
FROM texts t LEFT JOIN digests USING (d) LEFT JOIN kept USING (d)
"""


@_register("op12_periodic_runs", _OP12)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    docs = _table(spark, folder, "documents").select(
        "doc_id", "text", hashed.alias("h"), F.floor(hashed / 10).alias("g"), words(F.col("text")).alias("w")
    )
    n, g = F.size("w").cast("bigint"), F.col("g")
    a, p = g % n, 1 + F.floor((n - g % n) / (3 + g % 8))
    period = F.slice("w", (a + 1).cast("int"), p.cast("int"))
    again = F.flatten(F.array_repeat(period, F.ceil((n - a) / p).cast("int")))
    periodic = F.concat(
        F.slice("w", F.lit(1), a.cast("int")), F.slice(again, F.lit(1), (n - a).cast("int"))
    )
    text = F.when((F.col("h") % 10 == 0) & (n > 0), F.array_join(periodic, " ")).otherwise(F.col("text"))
    found = periods.collapse_runs(docs.select("doc_id", text.alias("text")), carry=["doc_id"])
    longest = F.array_min(F.transform("runs", lambda r: F.struct(-r["length"], r["start"], r["period"])))
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    ends = F.transform(line, lambda x: F.concat(x, F.lit("\n")))
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        longest["start"].alias("start"),
        (-longest["col1"]).alias("length"),
        longest["period"].alias("period"),
        F.floor(-1000 * longest["col1"] / longest["period"]).alias("exponent_milli"),
        F.sha2(F.array_join(ends, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


_OP13 = """
WITH vectors AS (
  SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.r, q.vec_id AS query_id, p.vec_id, CAST(list_inner_product(q.v, p.v) AS BIGINT) AS score
  FROM vectors q JOIN vectors p ON q.vec_id % 50 = 0 AND q.r <> p.r
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id NULLS LAST) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INT) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""


@_register("op13_top_products", _OP13)
def op13(spark: SparkSession, folder: str) -> DataFrame:
    given = _table(spark, folder, "embeddings").select("vec_id", "embedding")
    x = F.transform("embedding", lambda v: v.cast("double"))
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    whole = F.transform(x, lambda v: F.floor(v * 256))
    vectors = given.where(finite).select("vec_id", whole.alias("vector"))
    return top_products.top_products(vectors, F.col("vec_id") % 50 == 0, k=5)
