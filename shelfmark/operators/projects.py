"""SQL statements and pipelines of ETL project files, read without parsing a file as a whole."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import partial
from xml.parsers import expat

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfmark.session import hand_over
from shelfmark.skew import lookup_join
from shelfmark.sources.readers import scan_pieces

TASK_END = "</DTS:Executable>"

# attribute values are passed over whole, as they may hold brackets
_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
_TAGS = re.compile(
    r"<(?:!--[\s\S]*?-->|!\[CDATA\[[\s\S]*?\]\]>|/DTS:Executable\s*>"
    rf"|(?:DTS:Executable|SQLTask:SqlTaskData|AmazonRedshiftExecuteSqlTask)(?=[\s/>]){_ATTRIBUTES}"
    r"|pipeline(?=[\s/>])[\s\S]*?</pipeline>)",
    re.ASCII,
)
_ROWS = 5_000  # rows that a scan gives at once
_FIELDS = (
    "`DTS:Executable` struct<`_DTS:DTSID`: string, `_DTS:ObjectName`: string>, "
    "`SQLTask:SqlTaskData` struct<`_SQLTask:SqlStatementSource`: string>, "
    "AmazonRedshiftExecuteSqlTask struct<_SqlStatementSource: string>"
)


# what of a start tag and of a pipeline is read by ``_scan`` itself; all else is left to Spark's XML parser
_NAMED = re.compile(r"""\s+([A-Za-z_][\w.:-]*+)=(?:"([^"<\t\n\r]*+)"|'([^'<\t\n\r]*+)')""", re.ASCII)
_PLAIN = re.compile(rf"<[\w:]++(?:{_NAMED.pattern})*+\s*+/?>", re.ASCII)
_NO_TEXT = re.compile("[\x00-\x08\x0b\x0c\x0e-\x1f\ufffe\uffff]")
_ENTITY = re.compile(r"&(?:#([0-9]{1,7})|#x([0-9A-Fa-f]{1,6})|(amp|lt|gt|quot|apos));|&")
_CHARS = {"amp": "&", "lt": "<", "gt": ">", "quot": '"', "apos": "'"}
_END_WITH_BLANKS = re.compile(r"</pipeline\s")
_STATEMENT = {"<S": "SQLTask:SqlStatementSource", "<A": "SqlStatementSource"}
_READ = {n.lower(): n for n in ("DTS:DTSID", "DTS:ObjectName", *_STATEMENT.values())}
_OWNER = ("DTS:DTSID", "DTS:ObjectName")
_NOWHERE = (None, None, None)
_PARSED = 1 << 24  # a longer text is not parsed as a whole, as its rows are held until its end
_COLUMNS = (
    "file string, block bigint, place bigint, kind string, task_id string, title string, statement string, "
    "target string, owner string, item string, ends bigint, net bigint"
)


class _Odd(ValueError):
    """Text that is left to Spark's XML parser."""


def _char(m: re.Match) -> str:
    if m[3]:
        return _CHARS[m[3]]
    code = int(m[1]) if m[1] else int(m[2], 16) if m[2] else 0
    if code in (9, 10, 13) or 0x20 <= code <= 0xD7FF or 0xE000 <= code <= 0xFFFD or 0x10000 <= code <= 0x10FFFF:
        return chr(code)
    raise _Odd


def _attributes(tag: str) -> dict[str, str]:
    """Attributes of a well-formed start tag."""
    if not _PLAIN.fullmatch(tag) or _NO_TEXT.search(tag):
        raise _Odd
    found: dict[str, str] = {}
    for name, double, single in _NAMED.findall(tag):
        value = double or single
        if name in found or (name.lower() in _READ and not (value and name == _READ[name.lower()])):
            raise _Odd
        found[name] = _ENTITY.sub(_char, value) if "&" in value else value
    return found


def _pipeline(item: str) -> tuple[str, list[str]]:
    """Query and target tables of a pipeline whose properties hold nothing but text."""
    if "<!" in item or "<?" in item or _NO_TEXT.search(item):
        raise _Odd
    open_ones: list[list[str] | None] = []
    found: dict[str, list[list[str]]] = {"Query": [], "TableName": []}

    def start(name: str, attributes: dict[str, str]) -> None:
        if open_ones and open_ones[-1] is not None:
            raise _Odd
        kept = found.get(attributes.get("name", "")) if name == "property" else None
        open_ones.append(None if kept is None else [])
        if kept is not None:
            kept.append(open_ones[-1])

    def text(data: str) -> None:
        if open_ones[-1] is not None:
            open_ones[-1].append(data)

    parser = expat.ParserCreate()
    parser.StartElementHandler, parser.CharacterDataHandler = start, text
    parser.EndElementHandler = lambda _: open_ones.pop()
    try:
        parser.Parse(item, True)
    except expat.ExpatError as wrong:
        raise _Odd from wrong
    whole = {name: ["".join(parts) for parts in texts] for name, texts in found.items()}
    return (whole["Query"] or [""])[0], [t for t in whole["TableName"] if t]


def _parsed(content: str) -> list[tuple]:
    """Tasks and pipelines of a whole project that is well-formed and has nothing odd, by one pass of a parser.

    What ``_scanned`` leaves to Spark's parser, or may see otherwise than a parser does, is odd here.
    """
    # the parser itself rejects all other characters that are none of XML
    if "\ufffe" in content or "\uffff" in content or _END_WITH_BLANKS.search(content):
        raise _Odd
    rows: list[tuple] = []
    stack: list[dict[str, str]] = []  # attributes of the tasks around
    statements = {"SQLTask:SqlTaskData": _STATEMENT["<S"], "AmazonRedshiftExecuteSqlTask": _STATEMENT["<A"]}
    within = pipelines = 0  # depth in a pipeline, and how many there are
    found: dict[str, list[list[str]]] = {}
    text: list[str] | None = None
    childless = False
    parser = expat.ParserCreate()

    def read(attributes: dict[str, str], *names: str) -> tuple:
        for name, value in attributes.items():
            known = _READ.get(name.lower())
            if known and not (value and name == known):
                raise _Odd
        return tuple(map(attributes.get, names))

    def owner() -> tuple:
        return read(stack[-1], *_OWNER) if stack else (None, None)

    def start(name: str, attributes: dict[str, str]) -> None:
        nonlocal within, found, text, childless
        if within:
            if text is not None or name == "pipeline":
                raise _Odd
            within, childless = within + 1, False
            kept = found.get(attributes.get("name", "")) if name == "property" else None
            if kept is not None:
                text = []
                kept.append(text)
                parser.CharacterDataHandler = text.append
        elif name == "DTS:Executable":
            stack.append(attributes)
        elif name == "pipeline":
            within, childless, found = 1, True, {"Query": [], "TableName": []}
        elif name in statements:
            around = owner()
            (statement,) = read(attributes, statements[name])
            if statement:
                rows.append((*_NOWHERE, "task", *around, statement, None, None, None, None, None))

    def end(name: str) -> None:
        nonlocal within, text, pipelines
        if within:
            within -= 1
            if text is not None:
                text = parser.CharacterDataHandler = None
            if not within:
                if childless:
                    raise _Odd
                pipelines += 1
                around = owner()
                query = "".join(found["Query"][0]) if found["Query"] else ""
                for target in map("".join, found["TableName"]) if query else ():
                    if target:
                        rows.append((*_NOWHERE, "pipeline", *around, query, target, None, None, None, None))
        elif name == "DTS:Executable":
            stack.pop()

    def odd(*_: object) -> None:
        raise _Odd

    def odd_within(*_: object) -> None:
        if within:
            raise _Odd

    parser.StartElementHandler, parser.EndElementHandler = start, end
    parser.CommentHandler = parser.StartCdataSectionHandler = odd_within
    parser.ProcessingInstructionHandler = parser.StartDoctypeDeclHandler = odd
    try:
        parser.Parse(content, True)
    except expat.ExpatError as wrong:
        raise _Odd from wrong
    if content.count("</pipeline>") != pipelines:
        raise _Odd
    return rows


def _scanned(content: str, whole: bool, at: tuple) -> Iterator[tuple]:
    """What one text holds, as rows of ``_COLUMNS``: tasks and pipelines, and those left to Spark's parser
    as ``raw``. Of a text that is no whole project also items whose task began before it as ``waiting``
    (after ``ends`` end tags of earlier tasks), tasks that go on after it as ``open`` and, if there
    are such or ``ends``, the change of depth; these have the text's place ``at``.
    """
    stack: list[str] = []
    names: list[tuple | None] = []  # id and title, once they are asked for
    ends = 0
    for match in _TAGS.finditer(content):
        tag = match[0]
        first = tag[1]
        if first == "!":
            continue
        if first == "/":
            if stack:
                stack.pop(), names.pop()
            else:
                ends += 1
        elif first == "D":
            if tag[-2] != "/":
                stack.append(tag), names.append(None)
        elif not stack and not whole:
            yield (*at, "waiting", None, None, None, None, None, tag, ends, None)
        else:
            try:
                owner = names[-1] if stack else (None, None)
                if owner is None:
                    around = _attributes(stack[-1])
                    owner = names[-1] = tuple(map(around.get, _OWNER))
                if first == "p":
                    query, targets = _pipeline(tag)
                    if query:
                        for target in targets:
                            yield (*_NOWHERE, "pipeline", *owner, query, target, None, None, None, None)
                else:
                    statement = _attributes(tag).get(_STATEMENT[tag[:2]])
                    if statement:
                        yield (*_NOWHERE, "task", *owner, statement, None, None, None, None, None)
            except _Odd:
                yield (*_NOWHERE, "raw", None, None, None, None, stack[-1] if stack else None, tag, None, None)
    if whole:
        return
    for no, tag in enumerate(stack):
        yield (*at, "open", None, None, None, None, tag, None, ends - no - 1, None)
    if stack or ends:
        yield (*at, "net", None, None, None, None, None, None, None, len(stack) - ends)


def _rows_of(content: str, whole: bool, at: tuple) -> Iterable[tuple]:
    """Rows of a text: of a whole project by a parser, if it is well-formed and has nothing odd."""
    if whole and 0 < len(content) <= _PARSED:
        try:
            return _parsed(content)
        except _Odd:
            pass
    return _scanned(content, whole, at)


def _scan(whole: bool, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [c.split()[0] for c in _COLUMNS.split(", ")]
    schema = pa.schema([(n, pa.int64() if n in ("block", "place", "ends", "net") else pa.string()) for n in names])

    def given(found: list[tuple]) -> pa.RecordBatch:
        columns = zip(*found, strict=True) if found else [()] * len(schema)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    for batch in batches:
        found: list[tuple] = []
        for file, block, place, content in zip(*(batch.column(i) for i in range(4)), strict=True):
            at = (file.as_py(), block.as_py(), place.as_py())
            text = (content.as_py() or b"").decode("utf-8", "replace")
            for row in _rows_of(text, whole, at):
                found.append(row)
                if len(found) == _ROWS:
                    yield given(found)
                    found = []
        yield given(found)


def _with_owners(found: DataFrame) -> DataFrame:
    """(owner, item): items that are left to Spark's parser, with the start tag of the task around them.

    Those that wait for a task of an earlier piece get it here. The depth of a tag is a prefix sum of
    the changes of depth, first over the blocks of a file and then within each. The owner is the last
    start tag of the item's depth: in the item's own block, or in the last earlier one that has any.
    Only pieces in which tasks begin or end that other pieces go on with have a part in this.
    """
    in_order = Window.partitionBy("file", "block").orderBy("place")
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    # within a place what waits comes before what opens; the change of depth counts after both
    tags = found.where("kind in ('waiting', 'open', 'net')").select(
        "file", "block", "place", "owner", "item", F.coalesce("ends", F.lit(0)).alias("ends"), F.coalesce("net", F.lit(0)).alias("net")
    )
    blocks = (
        tags.groupBy("file", "block").agg(F.sum("net").alias("net"))
        .select("file", "block", F.coalesce(F.sum("net").over(earlier), F.lit(0)).alias("before"))
    )
    inside = F.coalesce(F.sum("net").over(in_order.rangeBetween(Window.unboundedPreceding, -1)), F.lit(0))
    deep = (
        lookup_join(tags.withColumn("inside", inside), blocks, ["file", "block"])
        .withColumn("depth", F.col("before") + F.col("inside") - F.col("ends"))
        .where("owner is not null or item is not null")
    )
    at_depth = Window.partitionBy("file", "block", "depth").orderBy("place", F.col("item").isNull())
    owned = deep.withColumn("own", F.last("owner", ignorenulls=True).over(at_depth))
    items = owned.where("item is not null")
    starts = deep.where("owner is not null").groupBy("file", "depth", F.col("block").alias("from")).agg(
        F.max_by("owner", "place").alias("start")
    )
    # one row per depth at which a block goes on with a task of an earlier block
    open_ones = items.where("own is null and depth > 0").select("file", "depth", "block").distinct()
    carried = (
        open_ones.join(starts, ["file", "depth"])
        .where(F.col("from") < F.col("block"))
        .groupBy("file", "depth", "block")
        .agg(F.max_by("start", "from").alias("carried"))
    )
    waited = lookup_join(items, carried, ["file", "depth", "block"]).select(F.coalesce("own", "carried").alias("owner"), "item")
    return found.where("kind = 'raw'").select("owner", "item").unionByName(waited)


def xml_task_lineage(files: DataFrame, content: str = "content") -> tuple[DataFrame, DataFrame]:
    """SQL statements and pipelines of ETL project files.

    The first table has a row per task with SQL text: ``task_id``, ``title``, ``statement``; feed
    it to ``split_statements`` and ``sql_table_lineage``. The second has a row per pipeline with a
    query and a target table: ``task_id``, ``title``, ``query``, ``target``. Id and title are those of
    the task around it, null if it has none or the attribute is missing.

    ``files`` has one project per row, or pieces of projects as ``task_pieces`` cuts them. Every text is
    read where it lies: a well-formed project is parsed in one pass, other texts are scanned for tags,
    which are read with the task around them. That task is as a rule in the same text, so no text
    is shuffled. Tags that are not plain, and those whose task
    began in an earlier piece, are parsed by Spark. Tags in comments and CDATA sections don't
    count; in pieces no such section may hold the end of a task.
    """
    whole = "block" not in files.columns
    if whole:
        files = files.select(
            F.monotonically_increasing_id().alias("file"), F.lit(0).alias("block"), F.lit(0).alias("place"), content
        )
    texts = files.select(
        F.col("file").cast("string").alias("file"), F.col("block").cast("bigint").alias("block"),
        F.col("place").cast("bigint").alias("place"), F.col(content).cast("binary").alias("content"),
    )
    scanned = hand_over(texts.mapInArrow(partial(_scan, whole), _COLUMNS), "project-tags")
    # the tasks around an item of a whole project are all in its row
    found = scanned.where("kind = 'raw'").select("owner", "item") if whole else _with_owners(scanned)
    closed = lambda tag: F.regexp_replace(F.coalesce(tag, F.lit("")), r"/?>$", "/>")
    is_pipeline = F.col("item").startswith("<pipeline")
    xml = F.concat(F.lit("<task>"), closed(F.col("owner")), F.when(is_pipeline, "").otherwise(closed(F.col("item"))), F.lit("</task>"))
    options = {"rowTag": "task", "ignoreSurroundingSpaces": "false"}
    parsed = found.select("item", is_pipeline.alias("is_pipeline"), F.from_xml(xml, _FIELDS, options).alias("x"))
    owner = F.col("x")["DTS:Executable"]
    names = [owner["_DTS:DTSID"].alias("task_id"), owner["_DTS:ObjectName"].alias("title")]
    statement = F.coalesce(
        F.col("x")["SQLTask:SqlTaskData"]["_SQLTask:SqlStatementSource"],
        F.col("x")["AmazonRedshiftExecuteSqlTask"]["_SqlStatementSource"],
    )
    tasks = parsed.where("not is_pipeline").select(*names, statement.alias("statement"))
    parts = parsed.where("is_pipeline").select(
        *names,
        F.xpath_string("item", F.lit('//property[@name="Query"]')).alias("query"),
        F.explode(F.xpath("item", F.lit('//property[@name="TableName"]/text()'))).alias("target"),
    )
    read = [scanned.where(f"kind = '{kind}'") for kind in ("task", "pipeline")]
    return (
        read[0].select("task_id", "title", "statement").unionByName(tasks.where("statement <> ''")),
        read[1].select("task_id", "title", F.col("statement").alias("query"), "target").unionByName(parts.where("query <> ''")),
    )


def task_pieces(spark: SparkSession, path: str) -> DataFrame:
    """Project files cut after the end of each task, however large a file is, for
    ``xml_task_lineage``. What follows the last task of a file has an end too many, and no tasks.
    """
    cut = scan_pieces(spark, path, TASK_END)
    return cut.withColumn("content", F.concat("content", F.lit(TASK_END)))
