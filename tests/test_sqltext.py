import pytest
from conftest import rows

from shelfmark.operators import projects
from shelfmark.operators import sqltext as S
from shelfmark.operators.lineage import lineage_edges
from shelfmark.session import scratch_log


def one(spark, sql):
    return spark.createDataFrame([(sql,)], "sql string")


@pytest.mark.parametrize(
    "sql, statements",
    [
        ("select 1; select 2", ["select 1", "select 2"]),
        ("select ';' ; ;", ["select ';'"]),
        ("select 'it''s; ok'; x", ["select 'it''s; ok'", "x"]),
        ("-- a; b\nselect 1 /* c; 'd */ ; select \"a;b\"", ["select 1", 'select "a;b"']),
        ("select '--no comment', '/* nor this */'", ["select '--no comment', '/* nor this */'"]),
        ("select 'open ; end", ["select 'open", "end"]),
        ("", []),
    ],
)
def test_split(spark, sql, statements):
    got = S.split_statements(one(spark, sql), "sql").orderBy("statement_no").collect()
    assert [r.statement for r in got] == statements
    assert [r.statement_no for r in got] == list(range(len(statements)))


def test_long_statements_are_split_whole(spark):
    long = "insert into t values " + ", ".join(f"('a;{i}')" for i in range(20_000))
    got = S.split_statements(one(spark, f"{long}; select 1"), "sql").collect()
    assert [len(r.statement) for r in got] == [len(long), 8]


@pytest.mark.parametrize(
    "sql, sources, target",
    [
        ("INSERT INTO m.t SELECT * FROM a.b x JOIN c ON x.i = c.i", {"a.b", "c"}, "m.t"),
        ("insert into t select * from a, b as c, d.e f where 1=1", {"a", "b", "d.e"}, "t"),
        ("insert into t (x, y) select * from (select * from deep.er) q", {"deep.er"}, "t"),
        ("insert into t select * from a left outer join b using (k) cross join c", {"a", "b", "c"}, "t"),
        ("insert into t with w as (select * from a), v as (select 1 from w) select * from v join b", {"a", "b"}, "t"),
        ("insert into t select extract(year from d), 'from fake' from a -- from comment", {"a"}, "t"),
        ('insert into "S"."T" select * from `a`.`b`', {"a.b"}, "S.T"),
        ("insert into t select 1 from a union all select 2 from b", {"a", "b"}, "t"),
        ("insert into t select * FROM (SELECT 1 FROM s.a) x, s.b", {"s.a", "s.b"}, "t"),
        ("insert into t select * from a join b on (a.i = b.i and f(a.x, b.y) > 0), c", {"a", "b", "c"}, "t"),
        ("insert into t select f(a) x, y from (a join (b cross join c) on 1 = 1), only d", {"a", "b", "c", "d"}, "t"),
        ('insert into "my schema" . "my table" select * from "my schema"."your table" q, [x y].z', {"my schema.your table", "x y.z"}, "my schema.my table"),
        ("insert into t select * from a where d IS DISTINCT FROM s.col and e is not distinct from s.c", {"a"}, "t"),
        ("insert into t select extract(year from coalesce(d, trim(both from x))) from a", {"a"}, "t"),
        ("insert into t select * from a where i in (select i from b where j in (select j from c, d))", {"a", "b", "c", "d"}, "t"),
        ("copy s.t from 's3://b/k' csv", {"s3://b/k"}, "s.t"),
        ("select * from a", set(), None),
        ("insert into t values (1)", set(), None),
        ("show tables", set(), None),
    ],
)
def test_lineage(spark, sql, sources, target):
    flows = S.sql_table_lineage(one(spark, sql), "sql")
    edges = lineage_edges(flows).collect()
    assert {e.src for e in edges if e.dst == e.dataflow} == sources
    assert {e.dst for e in edges if e.src == e.dataflow} == ({target} if target else set())
    assert {e.src_otype for e in edges} <= {"table", "file", "dataflow"}


def test_same_text_gives_one_dataflow(spark):
    df = spark.createDataFrame([("insert into t select 1 from a",)] * 3, "sql string")
    assert S.sql_table_lineage(df, "sql").count() == 1


def test_resolve(spark, no_broadcast):
    catalog = spark.createDataFrame(
        [("sales", "orders", "1.sales.orders"), ("db.sales", "items", "2.db.sales.items"), ("hr", "orders", "3.hr.orders")],
        "schema string, table string, key string",
    )
    names = spark.createDataFrame(
        [(n,) for n in ("Sales.ORDERS", "orders", "hr.orders", "sales.items", "no.orders", None)], "name string"
    )
    got = {r.name: r.key for r in S.resolve_tables(names, catalog).collect()}
    assert got == {
        "Sales.ORDERS": "1.sales.orders", "orders": "1.sales.orders", "hr.orders": "3.hr.orders",
        "sales.items": "2.db.sales.items", "no.orders": None, None: None,
    }


def test_names_of_any_length(spark, no_broadcast):
    catalog = spark.createDataFrame(
        [
            ("prod.sales", "orders", "1.prod.sales.orders"), ("sales", "orders", "2.sales.orders"), ("Hr", "People", "3.hr.people"),
            ("", "alone", "4.alone"), (None, "orphan", "5.orphan"), ("hr", "a.b", "6.hr.a.b"), ("x.hr", "people", "0.x.hr.people"),
            ("x", None, "7.x"),
        ],
        "schema string, table string, key string",
    )
    want = {
        "prod.sales.orders": "1.prod.sales.orders",  # all parts
        '"Prod" . [Sales].`ORDERS`': "1.prod.sales.orders",
        "srv.prod.sales.orders": "1.prod.sales.orders",  # more than the catalog knows
        "dev.sales.orders": "2.sales.orders",
        "sales.orders": "2.sales.orders",  # the whole name comes before the tail of a longer one
        "orders": "1.prod.sales.orders",  # two tails: the lowest key
        "prod.orders": "1.prod.sales.orders",  # another part of the schema
        "hr.people": "3.hr.people", "z.hr.people": "3.hr.people", "people": "0.x.hr.people",
        "alone": "4.alone", "any.alone": None, "orphan": "5.orphan", 'hr."a.b"': "6.hr.a.b", "hr.a.b": None, "": None, "..": None,
    }
    names = spark.createDataFrame([(n,) for n in [*want, *want, None]], "name string")
    found = S.resolve_tables(names, catalog).collect()
    assert len(found) == 2 * len(want) + 1
    assert {r.name: r.key for r in found} == want | {None: None}
    assert S.resolve_tables(names, catalog.limit(0)).where("key is not null").count() == 0
    assert S.resolve_tables(names.limit(0), catalog).count() == 0


def test_mentions(spark, no_broadcast):
    cols = spark.createDataFrame([("tab", "COL", 7), ("TAB", "col", 5)], "table string, column string, id int")
    df = spark.createDataFrame([(1, "TAB.COL and TAB.COL, T.X"), (2, "none"), (3, None)], "id int, text string")
    got = {r.id: r.text for r in S.mention_resolve(df, "id", "text", cols).collect()}
    link = '<p><a data-oid="5" data-otype="attribute" href="/attribute/5/">TAB.COL</a></p>'
    assert got == {1: f"{link} and {link}, T.X", 2: "none", 3: None}


def test_dictionary(spark, no_broadcast):
    catalog = spark.createDataFrame([("s", "t", "1.s.t")], "schema string, table string, key string")
    log = one(spark, "select * FROM S.t JOIN\n s.T2 join s.t").selectExpr("1 as id", "sql")
    assert rows(S.text_dictionary_match(log, "id", "sql", catalog), "pos", "statement", "key") == [
        (0, "from", "1.s.t"), (2, "join", "1.s.t"),
    ]


def test_dictionary_reads_quoted_and_long_names(spark, no_broadcast):
    catalog = spark.createDataFrame([("s", "t", "1.s.t")], "schema string, table string, key string")
    log = one(spark, 'select 1 FROM "S"."T" x join (db.s.t) join `my db`.[s]."t" join u from t where from_t = from').selectExpr("1 as id", "sql")
    assert rows(S.text_dictionary_match(log, "id", "sql", catalog), "pos", "statement", "schema", "table", "key") == [
        (0, "from", "s", "t", "1.s.t"), (1, "join", "db.s", "t", "1.s.t"), (2, "join", "my db.s", "t", "1.s.t"), (4, "from", "", "t", "1.s.t"),
    ]


XML = """<Root xmlns:DTS="d" xmlns:SQLTask="s">
<DTS:Executable DTS:DTSID="{1}" DTS:ObjectName="First"><DTS:ObjectData>
<SQLTask:SqlTaskData SQLTask:SqlStatementSource="insert into a select * from b, c; select 1"/></DTS:ObjectData></DTS:Executable>
<DTS:Executable DTS:DTSID="{2}" DTS:ObjectName="Second"><DTS:ObjectData>
<SQLTask:SqlTaskData SQLTask:SqlStatementSource="truncate table x"/></DTS:ObjectData></DTS:Executable>
<AmazonRedshiftExecuteSqlTask Connection="c" SqlStatementSource="COPY p FROM 's3://x'"/>
<pipeline><component><property name="Query">select * from (select 1 from q) z</property></component>
<component><property name="TableName">out1</property><property name="Other">no</property></component></pipeline>
<pipeline><component><property name="TableName">alone</property></component></pipeline></Root>"""


def test_xml(spark):
    tasks, pipelines = projects.xml_task_lineage(spark.createDataFrame([(XML,)], "content string"))
    assert rows(tasks, "task_id", "title") == sorted(
        [("{1}", "First"), ("{2}", "Second"), (None, None)], key=repr
    )
    flows = S.sql_table_lineage(S.split_statements(tasks.drop("task_id").withColumnRenamed("statement", "s"), "s"))
    edges = lineage_edges(flows.unionByName(S.pipeline_lineage(pipelines)))
    assert rows(edges.where("dst = dataflow"), "src_otype", "src") == [
        ("file", "s3://x"), ("table", "b"), ("table", "c"), ("table", "q"),
    ]
    assert rows(edges.where("src = dataflow"), "dst_otype", "dst") == [
        ("table", "a"), ("table", "out1"), ("table", "p"),
    ]


def cut_at_tasks(spark, projects_by_file, per_block):
    """Pieces as the reader of large files gives them, with the given number of pieces per split."""
    pieces = []
    for file, xml in projects_by_file.items():
        for n, piece in enumerate(xml.split(projects.TASK_END)):
            pieces.append((file, n // per_block * 100, n, piece + projects.TASK_END))
    return spark.createDataFrame(pieces[::-1], "file string, block bigint, place bigint, content string")


def task(attributes, *sql, inner=""):
    data = "".join(f"<SQLTask:SqlTaskData SQLTask:SqlStatementSource='{q}'/>" for q in sql)
    return f"<DTS:Executable {attributes}>{inner}<DTS:ObjectData>{data}</DTS:ObjectData></DTS:Executable>"


def test_fields_of_a_task_stay_together(spark):
    name = 'DTS:ObjectName="{}" DTS:DTSID="{}"'.format
    first = "".join(
        [
            "<DTS:Executable><DTS:Executables>",
            task('DTS:DTSID="1"', "select 1"),  # no name
            task(name("Load B", 2), "select 2", "select &lt;2&gt; > &quot;&quot;"),
            "<!--", task(name("No", 0), "no"), "-->",
            task('DTS:ObjectName="Load C"', "select 3"),  # no id
            task(name("Empty", 4), ""),
            # a task whose own statement comes after the tasks inside it
            task(name("Outer", 5), "select 5", inner=task(name("In", 6), "select 6") + task(name("Self", 7)) + "<DTS:Executable a='/>'/>"),
            '<DTS:Executable DTS:DTSID="8"><AmazonRedshiftExecuteSqlTask SqlStatementSource="select 8"/></DTS:Executable>',
            "</DTS:Executables></DTS:Executable>",
        ]
    )
    pipe = '<pipeline><a><property name="Query">select 9 from q</property><property name="TableName">t1</property><property name="TableName">t2</property></a></pipeline>'
    second = f"<r>{pipe}{task(name('P', 9), inner=pipe)}</r>"
    want = {
        ("1", None, "select 1"), ("2", "Load B", "select 2"), ("2", "Load B", 'select <2> > ""'),
        (None, "Load C", "select 3"), ("5", "Outer", "select 5"), ("6", "In", "select 6"), ("8", None, "select 8"),
    }
    want_pipes = sorted([(i, t, "select 9 from q", x) for i, t in ((None, None), ("9", "P")) for x in ("t1", "t2")], key=repr)
    commented = first.replace("<!--", "").replace("-->", "")
    whole = spark.createDataFrame([(first,), (second,), (None,), ("",)], "content string")
    found = [projects.xml_task_lineage(whole)]
    for per_block in (1, 2, 3, 100):  # tasks open over many blocks
        cut = cut_at_tasks(spark, {"a": commented, "b": second}, per_block)
        found.append(projects.xml_task_lineage(cut))
    for n, (tasks, pipes) in enumerate(found):
        more = {("0", "No", "no")} if n else set()
        assert set(map(tuple, tasks.collect())) == want | more and tasks.count() == len(want | more)
        assert rows(pipes) == want_pipes


def test_large_project_is_read_by_several_tasks(spark, tmp_path):
    name = 'DTS:ObjectName="T{0}" DTS:DTSID="{0}"'.format
    body = "".join(task(name(i) if i % 5 else f'DTS:DTSID="{i}"', f"select {i}") for i in range(3000))
    (tmp_path / "p.dtsx").write_text(f"<DTS:Executable DTS:ObjectName='All'>{body}</DTS:Executable>\n")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "40000")
    try:
        pieces = projects.task_pieces(spark, str(tmp_path))
        assert pieces.rdd.getNumPartitions() > 5 and pieces.select("block").distinct().count() > 5
        tasks, _ = projects.xml_task_lineage(pieces)
        got = {r.task_id: (r.title, r.statement) for r in tasks.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert got == {str(i): (f"T{i}" if i % 5 else None, f"select {i}") for i in range(3000)}


def test_texts_of_pieces_are_scanned_once_and_not_shuffled(spark):
    body = "".join(task(f'DTS:DTSID="{i}"', f"select {i}") for i in range(40))
    pieces = cut_at_tasks(spark, {"a": f"<DTS:Executable>{body}</DTS:Executable>", "b": body}, 5)
    with scratch_log() as paths:
        tasks, _ = projects.xml_task_lineage(pieces)
    assert len(paths) == 1  # the texts are read once; what follows reads what was found in them
    found = spark.read.parquet(paths[0])
    # one task begins in a piece and ends in another; no other tag leaves its row
    assert rows(found.where("kind <> 'task'").groupBy("kind").count()) == [("net", 4), ("open", 1)]
    assert rows(found.where("kind = 'task'").agg({"owner": "count", "item": "count"})) == [(0, 0)]
    assert rows(tasks, "task_id", "statement") == sorted([(str(i), f"select {i}") for i in range(40)] * 2, key=repr)


def test_whole_projects_need_no_shuffle(spark):
    whole = spark.createDataFrame([(XML,), (XML.replace("<Root", "</DTS:Executable><Root"),)], "content string")
    for found in projects.xml_task_lineage(whole):
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Window" not in plan
    assert projects.xml_task_lineage(whole)[0].count() == 6


def test_odd_tags_are_read_by_the_parser(spark):
    """Tags and pipelines that the scan does not read itself."""
    q = '<property name="Query">select 1 from {}</property><property name="TableName">{}</property>'.format
    odd = "".join(
        [
            task('DTS:DTSID = "1"', "a&#xA;b", "c&#160;d"),  # blanks around the sign
            task('DTS:DTSID="2" DTS:ObjectName=""', "line\nbreak"),  # a break in an attribute is a blank
            task('DTS:DTSID="3"', "no &nbsp; entity"),
            task('DTS:DTSID="4" DTS:DTSID="4"', "named twice"),
            task('DTS:DTSID="5"', inner=f"<pipeline>{q('<![CDATA[a & b]]>', 'x<!-- -->y')}</pipeline>"),
            task('DTS:DTSID="6"', inner=f"<pipeline>{q('<b>c</b>', 'd &amp; e')}</pipeline>"),
        ]
    )
    whole = spark.createDataFrame([(f"<r>{odd}</r>",)], "content string")
    cut = cut_at_tasks(spark, {"a": f"<DTS:Executable>{odd}</DTS:Executable>"}, 2)
    for files in (whole, cut):
        tasks, pipelines = projects.xml_task_lineage(files)
        assert rows(tasks, "task_id", "statement") == [("1", "a\nb"), ("1", "c\xa0d"), ("2", "line break")]
        assert rows(pipelines, "task_id", "query", "target") == [
            ("5", "select 1 from a & b", "x"), ("5", "select 1 from a & b", "y"), ("6", "select 1 from c", "d & e"),
        ]


def test_a_well_formed_project_is_parsed_in_one_pass(monkeypatch):
    """Its tags are not scanned and read one by one, and the rows are those of the scan."""
    pipe = '<pipeline a="/>"><p><property name="Query">a &lt; b</property><property name="TableName">{}</property></p></pipeline>'.format
    both = f"<r>{task('DTS:DTSID="1"', 'x &gt; &#10;', inner=pipe('t'))}<!-- {task('', 'no')} --><![CDATA[<DTS:Executable>]]>{pipe('u')}</r>"
    odd = [
        both.replace("<r>", ""), both.replace("<r>", "<?a <DTS:Executable> ?><r>"), both.replace('DTSID="1"', 'dtsid="1"'),
        both.replace("</pipeline>", "</pipeline >", 1), both.replace("no", "</pipeline>"), both.replace('DTSID="1"', 'DTSID=""'),
        both.replace("<p>", "<p><!-- -->", 1), both.replace("<p>", "<p><pipeline>a</pipeline>", 1), both.replace("u", "\uffff"),
        both.replace("</pipeline>", "</pipeline ><!-- </pipeline> -->", 1), both.replace("<p>", "<pipeline/><p>", 1),
        both.replace("</property>", "<b/></property>", 1), both.replace("<r>", '<!DOCTYPE r [<!ENTITY e "f">]><r>'), "", "<r>",
    ]
    at = ("f", 0, 0)
    for text in (both, *odd):
        assert list(projects._rows_of(text, True, at)) == list(projects._scanned(text, True, at))
    expected = [r[4:8] for r in projects._scanned(both, True, at)]
    monkeypatch.setattr(projects, "_scanned", lambda *_: [][1])
    assert [r[4:8] for r in projects._rows_of(both, True, at)] == expected
    assert len(expected) == 3
