import os

import pytest
from pyspark.sql import functions as F

from docweave.operators.routing import route
from docweave.sinks.files import export_files
from docweave.sources.tree import PUSHDOWN, DocTree, Part, TreeReader, TreeWriter, extension, scan_tree

NAMES = ["a.md", "_b.mdx", ".c.md", "sub/_d.md", "sub/deep/e f.MD", "sub/deep/er/still/x.md", "_dir/é.md", "img.png", "no_extension", "sub/.md"]


def fill(root, names=NAMES):
    for n in names:
        p = root / n
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_text(f"content {n}", encoding="utf-8")


def texts(df):
    return {r.rel_path: bytes(r.content).decode() for r in df.collect()}


def tree(root):
    return {os.path.relpath(os.path.join(d, n), root): open(os.path.join(d, n), "rb").read() for d, _, names in os.walk(root) for n in names}


@pytest.mark.parametrize("depth", [0, 1, 2, 9])
def test_scan_reads_every_name(spark, tmp_path, depth):
    fill(tmp_path)
    for root in (str(tmp_path), f"file:{tmp_path}", f"file://{tmp_path}/"):
        assert texts(scan_tree(spark, root, depth=depth)) == {n: f"content {n}" for n in NAMES}
    rows = {r.rel_path: r for r in scan_tree(spark, str(tmp_path), depth=depth).drop("content").collect()}
    assert all(r.status == "ok" and r.error is None and r.length == len(f"content {n}".encode()) for n, r in rows.items())
    assert rows["sub/deep/e f.MD"].ext == ".MD" and rows["no_extension"].ext == "" and rows["sub/.md"].ext == ".md"


@pytest.mark.parametrize("pushed", ["true", "false"])
def test_filters(spark, tmp_path, pushed):
    fill(tmp_path)
    spark.conf.set(PUSHDOWN, pushed)
    try:
        md = scan_tree(spark, str(tmp_path), (".md", ".mdx"))
        assert set(texts(md)) == {n for n in NAMES if n.endswith((".md", ".mdx"))}
        assert set(texts(md.where("ext = '.md' and startswith(rel_path, 'sub/')"))) == {"sub/_d.md", "sub/.md", "sub/deep/er/still/x.md"}
        everything = scan_tree(spark, str(tmp_path))
        assert set(texts(everything.where("endswith(rel_path, 'x.md') or ext = '.png'"))) == {"sub/deep/er/still/x.md", "img.png"}
        assert set(texts(everything.where("endswith(rel_path, '.MD') and length > 0"))) == {"sub/deep/e f.MD"}
        assert texts(everything.where("ext = '.md' and ext in ('.png', '.mdx')")) == {}
    finally:
        spark.conf.set(PUSHDOWN, "false")


def test_pushed_filters_open_no_other_file(spark, tmp_path):
    fill(tmp_path)
    os.symlink("/proc/self/mem", tmp_path / "sub" / "bad.bin")
    spark.conf.set(PUSHDOWN, "true")
    try:
        plan = scan_tree(spark, str(tmp_path), (".md",))._jdf.queryExecution().executedPlan().toString()
        assert "Filter " not in plan.replace("RuntimeFilters", "")  # the source took the filter
        assert scan_tree(spark, str(tmp_path), (".md",)).where("status = 'failed'").count() == 0
        assert [r.rel_path for r in scan_tree(spark, str(tmp_path)).where("status = 'failed'").collect()] == ["sub/bad.bin"]
    finally:
        spark.conf.set(PUSHDOWN, "false")


def test_unreadable_files_fail_and_are_not_empty(spark, tmp_path):
    fill(tmp_path, ["ok.md", "empty.md"])
    (tmp_path / "empty.md").write_bytes(b"")
    os.symlink("/proc/self/mem", tmp_path / "bad.md")
    os.symlink(tmp_path / "nowhere", tmp_path / "gone.md")
    os.symlink(tmp_path, tmp_path / "loop")
    rows = {r.rel_path: r for r in scan_tree(spark, str(tmp_path)).withColumn("action", route(F.col("rel_path"), F.col("content"))).collect()}
    assert {n: (r.status, r.action) for n, r in rows.items()} == {
        "ok.md": ("ok", "translate"), "empty.md": ("ok", "translate"), "bad.md": ("failed", "failed"), "gone.md": ("failed", "failed")}
    assert bytes(rows["empty.md"].content) == b"" and rows["bad.md"].content is None and "Error" in rows["bad.md"].error
    with pytest.raises(Exception, match="nowhere"):
        scan_tree(spark, str(tmp_path / "nowhere")).count()


def test_a_crowded_folder_is_dealt_to_tasks(tmp_path, monkeypatch):
    fill(tmp_path, [f"many/{i:03d}.md" for i in range(25)] + ["many/sub/x.md", "y.md"])
    monkeypatch.setattr("docweave.sources.tree.DIR_FILES", 10)
    reader = TreeReader({"path": str(tmp_path)})
    parts = reader.partitions()
    assert sorted((p.folders, p.deep, p.shard, p.shards) for p in parts) == [
        ([""], False, 0, 1), (["many"], False, 0, 3), (["many"], False, 1, 3), (["many"], False, 2, 3), (["many/sub"], True, 0, 1)]
    found = [r for p in parts for b in reader.read(p) for r in b.column(0).to_pylist()]
    assert sorted(found) == sorted([f"many/{i:03d}.md" for i in range(25)] + ["many/sub/x.md", "y.md"])
    monkeypatch.setattr("docweave.sources.tree.BATCH_BYTES", 30)
    assert all(b.num_rows <= 2 for b in reader.read(Part(["many"], True)))
    monkeypatch.setattr("docweave.sources.tree.MAX_FILE", 3)
    assert {s for b in reader.read(Part([""], False)) for s in b.column(4).to_pylist()} == {"failed"}


def test_names_of_files():
    assert [extension(n) for n in ("a.md", ".md", "a.b/c", "x.tar.gz", "a.", "")] == [".md", ".md", "", ".gz", ".", ""]


def rows(spark, items):
    return spark.createDataFrame(items, "output_path string, content binary")


def test_append_and_overwrite(spark, tmp_path):
    root = tmp_path / "deep" / "out"
    export_files(rows(spark, [("a/b.md", b"1"), ("_c", b"2"), ("none", None), ("é/ f.md", "è".encode())]).repartition(3), str(root))
    assert tree(root) == {"a/b.md": b"1", "_c": b"2", "é/ f.md": "è".encode()}
    export_files(rows(spark, [("a/b.md", b"new"), ("d", b"")]), f"file:{root}")
    assert tree(root) == {"a/b.md": b"new", "_c": b"2", "é/ f.md": "è".encode(), "d": b""}
    export_files(rows(spark, [("x.md", b"only")]), str(root), mode="overwrite")
    assert tree(root) == {"x.md": b"only"}
    export_files(rows(spark, []), str(root), mode="overwrite")
    assert tree(root) == {} and root.is_dir() and os.listdir(root.parent) == ["out"]


@pytest.mark.parametrize("mode", ["append", "overwrite"])
def test_a_failing_job_leaves_the_tree(spark, tmp_path, mode):
    root = tmp_path / "out"
    export_files(rows(spark, [("a.md", b"old")]), str(root))
    for bad in ("../outside", "/abs", "a/../../b", "", "x/"):
        with pytest.raises(Exception, match="not a path"):
            export_files(rows(spark, [("a.md", b"new"), ("b.md", b"new"), (bad, b"bad")]).coalesce(1), str(root), mode=mode)
    assert tree(root) == {"a.md": b"old"} and os.listdir(tmp_path) == ["out"]


@pytest.mark.parametrize("overwrite", [True, False])
def test_a_killed_task_leaves_no_partial_file(tmp_path, overwrite):
    root = tmp_path / "out"
    fill(root, ["a.md"])
    writer = TreeWriter({"path": str(root)}, overwrite)

    def killed():
        yield {"rel_path": "a.md", "content": b"x" * 100}
        raise KeyboardInterrupt
    with pytest.raises(KeyboardInterrupt):
        writer.write(killed())
    assert tree(root) == {"a.md": b"content a.md"}
    # its other attempt ends, and the job commits
    assert writer.write(iter([{"rel_path": "a.md", "content": b"x" * 100}])).bytes == 100
    writer.commit([])
    assert tree(root) == {"a.md": b"x" * 100} and os.listdir(tmp_path) == ["out"]


def test_the_source_is_registered_by_name(spark, tmp_path):
    fill(tmp_path, ["q.md"])
    spark.dataSource.register(DocTree)
    assert spark.read.format("doc_tree").option("content", "false").load(str(tmp_path)).select("rel_path", "content").collect() == [("q.md", None)]
