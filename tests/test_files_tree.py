import json

from pyspark.sql import functions as F

from codequarry import schemas
from codequarry.limits import SERVICE_LIMITS, Limits
from codequarry.operators import files as file_ops
from codequarry.sources import store as store_io
from codequarry.sources.tree import read_trees, stage_files

DEEP = "/".join("abcdef")


def names(spark, paths, key="r"):
    return spark.createDataFrame(
        [(key, p, 1, bytearray(b"x")) for p in paths], schemas.FILES)


def test_tree_depths_and_pruning(spark):
    files = names(spark, [
        "top.py", "a/__init__.py", "docs/readme.md", ".hidden/x.py", "a/.secret/b/x.py", "a/venv/x.py", ".x.py",
        f"{DEEP}/five.py",      # directories to depth 5, file at depth 6
        f"{DEEP}/g/six.py",     # directory at depth 6 is kept, its file is not
        f"{DEEP}/g/h/seven.py",
    ])
    whole = {r.path for r in file_ops.tree_rows(files).collect()}
    assert {f"{DEEP}/g/six.py", f"{DEEP}/g/h", f"{DEEP}/g/h/seven.py"} <= whole
    tree = file_ops.tree_rows(files, SERVICE_LIMITS)
    got = {(r.path, r.type, r.depth, r.parent_path) for r in tree.collect()}
    assert {p for p, t, _, _ in got if t == "file"} == {"top.py", "a/__init__.py", ".x.py", f"{DEEP}/five.py"}
    assert {p for p, t, _, _ in got if t == "directory"} == {
        "a", "docs", "a/b", "a/b/c", "a/b/c/d", "a/b/c/d/e", DEEP, f"{DEEP}/g"}
    assert (f"{DEEP}/g", "directory", 6, DEEP) in got and ("a", "directory", 0, ".") in got
    totals = file_ops.tree_totals(tree).collect()[0]
    assert (totals.total_files, totals.total_directories) == (4, 9)
    ordered = [r.path for r in tree.orderBy(*file_ops.tree_order()).collect()]
    assert ordered.index("a") < ordered.index("a/__init__.py") < ordered.index("a/b") < ordered.index("docs")


def test_tree_as_json(spark, tmp_path):
    tree = file_ops.tree_rows(names(spark, ["a/b.py", "c.py"]))
    store_io.write_tree(tree, str(tmp_path / "t"))
    back = store_io.read_tree(spark, str(tmp_path / "t"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, tree.collect()))
    assert json.loads(next((tmp_path / "t").glob("*.json")).read_text().split("\n")[0])["repository_id"] == "r"


def test_limits(spark):
    many = names(spark, [f"d/{i}.py" for i in range(6)] + [".git/x", "sub/.git/y"])
    few = names(spark, ["a.py", "b.py"], "s")
    both = many.unionByName(few)
    strict = Limits(repository_files=5)
    sizes = {r.repository_id: (r.files, r.reject_reason) for r in file_ops.repository_sizes(both, strict).collect()}
    assert sizes == {"r": (6, "too many files"), "s": (2, None)}
    assert {r.reject_reason for r in file_ops.repository_sizes(both).collect()} == {None}
    exact = Limits(repository_files=6, repository_bytes=6)
    assert {r.reject_reason for r in file_ops.repository_sizes(both, exact).collect()} == {None}
    kept = file_ops.within_limits(both, file_ops.repository_sizes(both, strict))
    assert {r.repository_id for r in kept.collect()} == {"s"}
    capped = file_ops.cap_files(both.filter(F.col("rel_path").endswith(".py")), 5)
    assert sorted(r.rel_path for r in capped.filter("repository_id = 'r'").collect()) == [f"d/{i}.py" for i in range(5)]
    assert capped.filter("repository_id = 's'").count() == 2


def make(root):
    for rel, data in {
        "r1/pkg/__init__.py": b"", "r1/pkg/_a.py": b"x = 1\n", "r1/.hidden/h.py": b"h", "r1/venv/lib/v.py": b"v",
        "r1/readme.md": b"#", "r1/.git/config": b"g", "r2/big.py": b"y" * 3000, "r2/deep/er/z.py": b"z",
    }.items():
        target = root / rel
        target.parent.mkdir(parents=True, exist_ok=True)
        target.write_bytes(data)


def test_source_tree(spark, tmp_path):
    make(tmp_path)
    read = lambda **o: {(r.repository_id, r.rel_path, r.length, r.content and bytes(r.content)[:3])
                        for r in read_trees(spark, str(tmp_path), **o).collect()}
    want = {("r1", "pkg/__init__.py", 0, b""), ("r1", "pkg/_a.py", 6, b"x ="), ("r1", ".hidden/h.py", 1, b"h"),
            ("r2", "big.py", 3000, b"yyy"), ("r2", "deep/er/z.py", 1, b"z")}
    assert {(a, b, c, d or b"") for a, b, c, d in read()} == want
    for tasks, shares in ((1, 1), (3, 2), (100, 3)):
        again = read_trees(spark, str(tmp_path), tasks=tasks, shares=shares).collect()
        assert len(again) == 5 and {r.rel_path for r in again} == {p for _, p, _, _ in want}
    sizes = read(content="false", pattern="")
    assert {p for _, p, _, _ in sizes} == {
        "pkg/__init__.py", "pkg/_a.py", ".hidden/h.py", "venv/lib/v.py", "readme.md", ".git/config", "big.py",
        "deep/er/z.py"} and all(c is None for *_, c in sizes)
    assert ("r2", "big.py", 3000, None) in read(max_bytes=1000)
    one = read_trees(spark, str(tmp_path)).filter("repository_id = 'r2'")
    assert {r.rel_path for r in one.collect()} == {"big.py", "deep/er/z.py"}
    named = read_trees(spark, str(tmp_path / "r1"), repository_id="k")
    assert {r.repository_id for r in named.collect()} == {"k"}
    staged = stage_files(named, str(tmp_path / "staged"))
    assert file_ops.eligible(staged).count() == 2  # the empty file goes


def test_identical_files(spark):
    files = names(spark, ["a.py", "b.py"]).unionByName(names(spark, ["c.py"], "s"))
    row = file_ops.identical_files(files).collect()[0]
    assert (row.files, row.repositories) == (3, 2)
