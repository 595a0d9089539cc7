import ast
import glob
import hashlib
import textwrap

import pytest
from pyspark.sql import functions as F

from codequarry import schemas
from codequarry.limits import SERVICE_LIMITS
from codequarry.operators import chunks as chunk_ops
from codequarry.operators import extract
from codequarry.operators.visitor import python_facts
from codequarry.plans import ingest


def facts_of(source):
    return list(python_facts(textwrap.dedent(source)))


def short(fact):
    return fact["kind"], fact["name"], fact.get("owner"), fact["line_start"], fact["line_end"]


def test_walk():
    got = [short(f) for f in facts_of('''\
        from __future__ import annotations
        import os, sys
        try:
            import a
        except ImportError:
            from . import b
        @deco(
            1)
        class A(B, m.C, D[int], metaclass=M):
            import inside
            if True:
                def late(self): pass
            class Inner(A):
                async def deep(self):
                    class Never: pass
                    def never(): pass
            def late(self, x): return x
        if x:
            def f(): import no
        match x:
            case 1:
                def g(): ...
        def f(): pass
        ''')]
    assert got == [
        ("Module", None, None, 1, 24),
        ("Import", "import os, sys", None, 2, 2),
        ("Import", "import a", None, 4, 4),
        ("Import", "from . import b", None, 6, 6),
        ("Class", "A", None, 9, 17),
        ("Import", "import inside", None, 10, 10),
        ("Method", "late", "A", 12, 12),
        ("Class", "Inner", None, 13, 16),
        ("Method", "deep", "Inner", 14, 16),
        ("Method", "late", "A", 17, 17),
        ("Function", "f", None, 19, 19),
        ("Function", "g", None, 22, 22),
        ("Function", "f", None, 23, 23),
    ]


def test_bases_only_plain_names():
    fact = facts_of("class A(B, m.C, D[int], *E, metaclass=M): pass\n")[1]
    assert fact["bases"] == ["B"]


@pytest.mark.parametrize("head,want", [
    ("def f(): pass", "f()"),
    ("def f(a, b=1) -> dict[str, (int)]: pass", "f(a, b=1)"),
    ("async def f (a=')', *, b=(1, [2])): pass", "f(a=')', *, b=(1, [2]))"),
    ("def f[T: (int, str)](x: T, y: 'é)' = {'a': ')'}): pass", "f(x: T, y: 'é)' = {'a': ')'})"),
    ("def f(\n    a,  # one )\n    b,\n):\n    pass", "f(\n    a,  # one )\n    b,\n)"),
    ("def deff(x):\n    @g\n    def h(): pass", "deff(x)"),
    ("def f(x=lambda: (yield)): pass", "f(x=lambda: (yield))"),
])
def test_signature(head, want):
    assert facts_of(head + "\n")[1]["signature"] == want


@pytest.mark.parametrize("body,raw", [
    ('"""doc"""', '"""doc"""'), ("'doc'", "'doc'"), ('r"""doc"""', 'r"""doc"""'), ('f"a{1}b"', 'f"a{1}b"'),
    ('b"x"', 'b"x"'), ('"a" "b"', None), ('("a")', None), ('# c\n    "doc"', '"doc"'), ("1", None),
    ('f"a{"b"}"', 'f"a{"b"}"'), ('"a".strip()', None),
])
def test_docstring(body, raw):
    assert facts_of(f"def f():\n    {body}\n")[1].get("docstring") == raw


def test_errors_and_marks():
    assert [f["kind"] for f in facts_of("def f(:\n")] == ["Module", "Error"]
    assert [f["kind"] for f in facts_of("x = '\0'\n")] == ["Module", "Error"]
    marked = list(python_facts("﻿def f(): pass\r\ndef g():\r\n    'é'\r\n"))
    assert [short(f) for f in marked[1:]] == [("Function", "f", None, 1, 1), ("Function", "g", None, 2, 3)]
    assert marked[1]["content"] == "def f(): pass"
    assert marked[0]["content"].startswith("﻿")


def _id(*key):
    return hashlib.sha256(":".join(key).encode()).hexdigest()[:16]


SOURCE = '''\
"""Top."""
import os
import os
class A(Base, Base, Other):
    """"quoted" text'"""
    def m(self): "d"
    def m(self): pass
class A(Base):
    pass
def f(password="hunter2hunter2"):
    api_key = "abcdefgh"
'''


@pytest.fixture(scope="module")
def made(spark):
    files = spark.createDataFrame(
        [("r1", "pkg/x.py", len(SOURCE), bytearray(SOURCE.encode())),
         ("r2", "pkg/x.py", len(SOURCE), bytearray(SOURCE.encode())),
         ("r2", "pkg/bad.py", 4, bytearray(b"def (")), ("r2", "pkg/x.txt", 3, bytearray(b"abc"))],
        schemas.FILES,
    )
    return ingest.extract_files(files)


def test_entities(made):
    found = {(r.repository_id, r.ordinal, r.file_path): r for r in made.entities.collect()}
    r1 = [found[("r1", i, "pkg/x.py")] for i in range(8)]
    module = _id("r1", "pkg/x.py", "Module", "pkg/x.py", "")
    klass = _id("r1", "pkg/x.py", "Class", "A", module)
    assert [r.id for r in r1] == [
        module, _id("r1", "pkg/x.py", "Import", "import os", module),
        _id("r1", "pkg/x.py", "Import", "import os", module), klass,
        _id("r1", "pkg/x.py", "Method", "m", klass), _id("r1", "pkg/x.py", "Method", "m", klass), klass,
        _id("r1", "pkg/x.py", "Function", "f", module),
    ]
    assert [r.repeated for r in r1] == [False, False, True, False, False, True, True, False]
    assert r1[0].name == "x" and r1[0].line_end == 12
    assert r1[3].docstring == "quoted\" text"
    assert r1[7].signature == 'f(password="hunter2hunter2")'
    assert "abcdefgh" not in r1[7].content and "[REDACTED_SECRET]" in r1[7].content
    assert made.errors.collect()[0].rel_path == "pkg/bad.py"


def test_nodes_edges_chunks(made):
    nodes = made.nodes.filter("repository_id = 'r1'").collect()
    assert len(nodes) == len({n.id for n in nodes}) == 5
    assert {n.name: n.content for n in nodes}["f"] == "f([REDACTED_SECRET]\")"
    edges = made.edges.filter("repository_id = 'r1'").collect()
    kinds = sorted(e.edge_type for e in edges)
    assert kinds == ["CONTAINS", "DEFINES", "DEFINES", "IMPORTS", "INHERITS", "INHERITS"]
    chunks = {c.entity_name: c for c in made.chunks.filter("repository_id = 'r1'").collect()}
    assert set(chunks) == {"x", "A", "m", "f"}
    assert "hunter2" not in chunks["f"].content and len(chunks["f"].embedding) == 384
    assert chunks["m"].content.split("\n")[:4] == [
        "# Method: m", "File: pkg/x.py", "Signature: m(self)", "Docstring: d"]
    totals = {t.repository_id: t for t in made.totals.collect()}
    assert tuple(totals["r1"])[1:] == (1, 8, 6, 5, 4)
    assert tuple(totals["r2"])[1:] == (2, 9, 7, 6, 5)


def test_cut_then_redact(spark):
    long = "def f():\n    x = '" + "a" * 3970 + "'\n    password = 'abcdefghij'\n"
    files = spark.createDataFrame([("r", "a.py", len(long), bytearray(long.encode()))], schemas.FILES)
    made = ingest.extract_files(files, limits=SERVICE_LIMITS)
    body = made.entities.filter("entity_type = 'Function'").collect()[0].content
    assert len(body) <= 4000 and body == long[:4000].rstrip("\n")[: len(body)]
    assert max(made.chunks.select(F.length("content")).collect())[0] <= 6000


def test_registry():
    with pytest.raises(ValueError):
        extract.visitor_for("cobol")
    assert extract.visitor_for("python") is python_facts


def test_another_language(spark, monkeypatch):
    monkeypatch.setattr(extract, "_VISITORS", dict(extract._VISITORS))
    monkeypatch.setattr(extract, "_SUFFIXES", dict(extract._SUFFIXES))

    def lines(text):
        yield {"kind": "Module", "name": None, "owner": None, "line_start": 1, "line_end": 1, "content": text}

    extract.register_language("notes", [".txt"], lines)
    files = spark.createDataFrame([("r", "a.txt", 3, bytearray(b"abc"))], schemas.FILES)
    assert [r.name for r in extract.entities(extract.facts(files)).collect()] == ["a"]


def test_model_vectors(spark):
    import numpy as np

    df = spark.createDataFrame([(1, "ab"), (2, "abc")], "id int, content string")
    made = chunk_ops.model_vectors(df, lambda: lambda texts: np.array([[len(t), 1] for t in texts]))
    assert {r.id: r.embedding for r in made.collect()} == {1: [2.0, 1.0], 2: [3.0, 1.0]}


def test_standard_library_facts_cover_the_tree():
    """Every definition outside functions is reported once, for real files."""
    for path in sorted(glob.glob("/opt/py313/lib/python3.13/[a-f]*.py"))[:40]:
        text = open(path, encoding="utf-8", errors="replace").read()
        found = list(python_facts(text))
        inside = set()
        tree = ast.parse(text)
        for node in ast.walk(tree):
            if isinstance(node, (ast.FunctionDef, ast.AsyncFunctionDef)):
                inside.update(id(n) for n in ast.walk(node) if n is not node)
        want = [n for n in ast.walk(tree) if id(n) not in inside and isinstance(
            n, (ast.ClassDef, ast.FunctionDef, ast.AsyncFunctionDef))]
        got = [f for f in found if f["kind"] in ("Class", "Function", "Method")]
        assert sorted((f["name"], f["line_start"]) for f in got) == sorted((n.name, n.lineno) for n in want)
        assert all(f["signature"].endswith(")") for f in got if f["kind"] != "Class")


def test_long_texts_are_whole_in_chunks(spark):
    """What lies past the old cuts is in numbered chunks; a secret across two pieces is redacted."""
    body = "".join(f"    x{i} = 'word{i}'\n" for i in range(1500)) + "    found = 'needle'\n"
    text = f"def f():\n{body}class A:\n    pass\n"
    text = text.replace("word300'", "password=" + "s" * 7000 + "'")
    files = spark.createDataFrame([("r", "a.py", len(text), bytearray(text.encode()))], schemas.FILES)
    made = ingest.extract_files(files)
    rows = made.chunks.select("id", "entity_id", "part", "entity_type", "content").collect()
    names = {r.id for r in made.nodes.collect()}
    assert {r.entity_id for r in rows} == names and sum(r.part == 1 for r in rows) == len(names)
    assert all(r.id == (r.entity_id if r.part == 1 else f"{r.entity_id}#{r.part}") for r in rows)
    assert len(rows) == len({r.id for r in rows}) == made.totals.collect()[0].distinct_chunks
    assert max(len(r.content) for r in rows) <= 6000 and not any("sss" in r.content for r in rows)
    for kind in ("Module", "Function"):
        mine = sorted((r for r in rows if r.entity_type == kind), key=lambda r: int((r.id + "#1").split("#")[1]))
        joined = "".join(r.content for r in mine)
        assert len(mine) > 4 and [r.id for r in mine[1:]] == [f"{mine[0].id}#{n}" for n in range(2, len(mine) + 1)]
        assert all(f"'word{i}'" in joined for i in range(1500) if i != 300) and "needle" in mine[-1].content
    whole = extract.entities(extract.facts(files)).filter("entity_type = 'Function'").collect()[0]
    assert "needle" in whole.content


BROKEN = {
    "statement": ("class A(B):\n    def f(self, x):\n        'doc'\n        x = = 1\n        return x\n\n    def g(self): return 2\n\n"
                  "def h():\n    pass\n",
                  [("Class", "A", 1, 7), ("Method", "f", 2, 5), ("Method", "g", 7, 7), ("Function", "h", 9, 10)], [(4, 4)]),
    "old syntax": ("import os\ndef f(a, (b, c)):\n    print 'x'\n    try:\n        g()\n    except E, e:\n        raise E, 'x'\n"
                   "    exec 'c' in d\n    return `a`\nclass C:\n    def m(self):\n        print >>x, 'y'\n        return 0777\n",
                   [("Import", "import os", 1, 1), ("Function", "f", 2, 9), ("Class", "C", 10, 13), ("Method", "m", 11, 13)],
                   [(2, 3), (6, 9), (13, 13)]),
    "open bracket": ("def a():\n    x = (1,\n    return 2\n\nx = [1,\n\nimport z\n\ndef b():\n    return 1\n",
                     [("Function", "a", 1, 3), ("Import", "import z", 7, 7), ("Function", "b", 9, 10)], [(2, 2), (5, 6)]),
    "open string": ("x = \'\'\'never closed\n\ndef b():\n    pass\n", [("Function", "b", 3, 4)], [(1, 2)]),
    "heading": ("def bad(:\n\ndef ok():\n    return 1\n\nclass K(:\n    def m(self):\n        pass\n",
                [("Function", "ok", 3, 4), ("Class", "K", 6, 8), ("Method", "m", 7, 8)], [(1, 1), (6, 6)]),
    "indentation": ("class K:\n    def m(self):\n        pass\n      x = 1\n    def o(self): pass\n",
                    [("Class", "K", 1, 5), ("Method", "m", 2, 3), ("Method", "o", 5, 5)], [(4, 4)]),
    "blocks": ("if x ==:\n    import b\nelse:\n    import c\n@dec(\ndef f(): pass\n",
               [("Import", "import b", 2, 2), ("Import", "import c", 4, 4), ("Function", "f", 6, 6)], [(2 - 1, 1), (5, 5)]),
    "string over lines": ("def (:\nx = \'\'\'\ndef no(): pass\n\'\'\'\ndef b(): pass\n", [("Function", "b", 5, 5)], [(1, 1)]),
}


@pytest.mark.parametrize("case", list(BROKEN))
def test_files_with_errors(case):
    text, found, errors = BROKEN[case]
    facts = facts_of(text)
    got = [(f["kind"], f["name"], f["line_start"], f["line_end"]) for f in facts if f["kind"] not in ("Module", "Error")]
    assert [g for g in got if g[:2] in [f[:2] for f in found]] == found
    assert sorted((f["line_start"], f["line_end"]) for f in facts if f["kind"] == "Error") == sorted(errors)
    lines = text.split("\n")
    for f in facts:
        if f["kind"] in ("Class", "Function", "Method"):
            assert f["content"] == "\n".join(lines[f["line_start"] - 1:f["line_end"]]).strip()


def test_one_error_costs_no_entity():
    """Real files, a statement of each broken: all entities stay, where they were."""
    for path in sorted(glob.glob("/opt/py313/lib/python3.13/[a-m]*.py"))[:60]:
        text = open(path, encoding="utf-8", errors="replace").read()
        lines = text.split("\n")
        at = [i for i, line in enumerate(lines) if line.lstrip().startswith("return ") and line.startswith("    ")
              and not line.rstrip().endswith(("(", "[", "{", "\\", ","))]
        if not at:
            continue
        i = at[len(text) % len(at)]
        lines[i] = lines[i].replace("return ", "return = = ", 1)
        place = lambda t: [(f["kind"], f["name"], f["owner"], f["line_start"], f["line_end"]) for f in facts_of(t)
                           if f["kind"] not in ("Module", "Error")]
        assert place("\n".join(lines)) == place(text), path


def test_error_spans(spark):
    rows = [("r", "a", 1, 2, "x"), ("r", "a", 3, 3, "x"), ("r", "a", 2, 2, "y"), ("r", "a", 5, 9, "x"), ("r", "a", 6, 7, "x"), ("r", "b", 1, 1, "x")]
    spans = extract.error_spans(spark.createDataFrame(rows, "repository_id string, rel_path string, line_start int, line_end int, parse_error string"))
    assert sorted(map(tuple, spans.collect())) == [("r", "a", 1, 3, 3), ("r", "a", 5, 9, 2), ("r", "b", 1, 1, 1)]


def test_texts_without_code_cost_little():
    import time

    start = time.time()
    facts = facts_of("(well, \"this isn't code\n    of any class\n" * 20_000)
    assert time.time() - start < 30 and {f["kind"] for f in facts[1:]} == {"Error"}


def test_a_broken_statement_is_not_refused_twice(monkeypatch):
    from types import SimpleNamespace

    from codequarry.operators import recovery

    tried = []
    monkeypatch.setattr(recovery, "ast", SimpleNamespace(parse=lambda text: tried.append(text) or ast.parse(text), Module=ast.Module))
    facts = facts_of("import a\n\n\nclass A:\n    x = = 1\n\n    def f(self):\n        return 1\n\n\nx = [1, 2\n")
    assert [f["kind"] for f in facts if f["kind"] != "Error"] == ["Module", "Import", "Class", "Method"]
    # Each text is given to the parser once, also one that it refuses.
    assert len(tried) == len(set(tried))


def test_what_lies_before_an_error_is_parsed_together(monkeypatch):
    from types import SimpleNamespace

    from codequarry.operators import recovery

    tried = []
    monkeypatch.setattr(recovery, "ast", SimpleNamespace(parse=lambda text: tried.append(text) or ast.parse(text), Module=ast.Module))
    facts = facts_of("import a\nimport b\n\nx = 1\n\nclass A:\n    x = = 1\n\n    def f(self):\n        return 1\n\nimport c\n")
    assert [(f["kind"], f["line_start"], f["line_end"]) for f in facts[1:]] == [
        ("Import", 1, 1), ("Import", 2, 2), ("Class", 6, 10), ("Method", 9, 10), ("Error", 7, 7), ("Import", 12, 12)]
    # Once for all before the class, once for the class without the line that was refused, once for what follows.
    assert len(tried) == 3


def test_facts_do_not_depend_on_how_a_text_was_refused():
    from codequarry.operators.visitor import _recovered

    odd = ["x = 1\n\\\ny = 2\nz = = 3\n", "if a:\n    b\nelse:\n    import c\ntry:\n    d\ndef f(): pass\n", "@d\nclass A: pass\nx = (1,\nimport y\n)\n",
           "x = (1 2\ndef f(): pass\n)\n", "s = 1\nif x:\n  y\n z\nimport q\n", "a = 1 + \\\n\nb = 1 1\n", "a = 1\rb = = 2\ndef f(): pass\n"]
    texts = [text for text, *_ in BROKEN.values()] + odd
    for path in sorted(glob.glob("/opt/py313/lib/python3.13/[n-z]*.py"))[:40]:
        lines = open(path, encoding="utf-8", errors="replace").read().split("\n")
        lines[len(lines) // 2:len(lines) // 2] = ["x = [1, 2", "    y = = 3"]
        texts.append("\n".join(lines))
    for text in texts:
        try:
            ast.parse(text)
        except SyntaxError as error:
            assert list(_recovered(text, error)) == list(_recovered(text, None))


def test_plain_headings_need_no_tokenizer(monkeypatch):
    def no_tokens(*_):
        raise AssertionError

    source = "async def main(key={'a': (1, \")\")}, *, b=rb'(', c=\"\"\")\"\"\"):  # ((\n    return key\n"
    want = [f.get("signature") for f in facts_of(source)]
    monkeypatch.setattr("codequarry.operators.visitor.tokenize.generate_tokens", no_tokens)
    assert [f.get("signature") for f in facts_of(source)] == want
    assert want[1] == "main(key={'a': (1, \")\")}, *, b=rb'(', c=\"\"\")\"\"\")"


def test_texts_of_a_batch_are_read_one_at_a_time():
    import pyarrow as pa

    from codequarry import schemas
    from pyspark.sql.pandas.types import to_arrow_schema

    read = []

    def visitor(text):
        read.append(text)
        return [{"kind": "Module", "content": text}]

    texts = ["x" * 1000] * 5000
    batch = pa.RecordBatch.from_arrays(
        [pa.array(["r"] * 5000), pa.array(["p"] * 5000), pa.array(["python"] * 5000), pa.array(texts)], names=list("abcd"))
    out = extract._visit({"python": visitor}, to_arrow_schema(schemas.FACTS))(iter([batch]))
    first = next(out)
    assert first.num_rows < 2500 and len(read) < 2500
    assert first.num_rows + sum(b.num_rows for b in out) == 5000


def test_redacted_facts_are_not_redacted_again(spark):
    source = 'class A:\n    """token: abcdefgh12"""\n    key = "api_key=abcdefgh12" + "password=token=abcdefgh12 sk-' + "a" * 24 + '=x"\n'
    files = spark.createDataFrame([("r", "a.py", bytearray(source.encode()))], "repository_id string, rel_path string, content binary")
    facts = extract.facts(files)
    safe = ingest._safe(facts, ingest.DEFAULT_LIMITS)
    once, twice = extract.entities(safe, redacted=True), extract.entities(safe)
    assert once.collect() == twice.collect() == extract.entities(facts).collect()
    plan = once._jdf.queryExecution().analyzed().toString()
    assert "REDACTED" not in plan.split("Project [repository_id", 1)[0]


def test_content_is_made_once_to_be_judged(spark):
    from codequarry.functions import paths

    made = spark.range(3).selectExpr("cast(format_string('%d', id) as binary) AS content").filter(~paths.is_binary("content"))
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    conditions = [line for line in plan.split("\n") if "Filter" in line]
    assert len(conditions) == 1 and conditions[0].count("format_string") == 1
    assert made.count() == 3


def _orders(spark, path, n=60):
    from datetime import date

    rows = [(i, i % 7, "OFP"[i % 3], f"{i % 5 + 1}-P", 100.0 + i, date(1996, 1, 2)) for i in range(n)]
    spark.createDataFrame(
        rows, "o_orderkey long, o_custkey long, o_orderstatus string, o_orderpriority string, o_totalprice double, o_orderdate date",
    ).coalesce(1).write.parquet(f"{path}/orders.parquet")
    return str(path)


def test_a_report_reads_its_nodes_in_short_files(spark, tmp_path, monkeypatch):
    """What a task of the report sorts does not grow with the table: no file has more than its share of rows."""
    from registry import extracted

    monkeypatch.setattr(extracted, "SORTED_ROWS", 9, raising=False)
    made, keep = [], extracted.materialise
    monkeypatch.setattr(extracted, "materialise", lambda *a: made.append(keep(*a)) or made[-1])
    found = extracted.extracted_overview(spark, _orders(spark, tmp_path))
    assert found.count() == 5
    assert made[0].count() == 60 * 7
    rows = made[0].groupBy(F.input_file_name()).count().agg(F.max("count")).first()[0]
    assert rows <= 9


def test_dangling_targets_need_no_texts(spark, tmp_path, monkeypatch):
    from registry import extracted

    made, keep = [], extracted.materialise
    monkeypatch.setattr(extracted, "materialise", lambda *a: made.append(keep(*a)) or made[-1])
    got = {tuple(r) for r in extracted.extracted_dangling(spark, _orders(spark, tmp_path)).select("targets", "edges").collect()}
    assert got == {(24, 24)}  # each of a repository's 12 files inherits from two classes that are not there
    assert "content" not in made[0].columns


def test_a_batch_is_gone_before_the_next_is_read():
    from collections import deque

    import pyarrow as pa
    from pyspark.sql.pandas.types import to_arrow_schema

    from codequarry import schemas
    from codequarry.operators import extract

    held, size = [], 8 << 20

    def batches():
        before = pa.total_allocated_bytes()
        for _ in range(3):
            held.append(pa.total_allocated_bytes() - before)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x]) for x in ("r", "a.py", "python", "#" * size)], names=["repository_id", "rel_path", "language", "source"])
        yield pa.RecordBatch.from_arrays([pa.array([], pa.string())] * 4, names=["repository_id", "rel_path", "language", "source"])

    found = lambda text: iter([{"kind": "Module", "content": text[:9]}])
    deque(extract._visit({"python": found}, to_arrow_schema(schemas.FACTS))(batches()), maxlen=0)
    assert len(held) == 3 and max(held) < size / 2
