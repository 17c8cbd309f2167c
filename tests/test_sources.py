"""Page files in, Markdown files out, streams, and the package on workers that don't have it."""

import os
import subprocess
import sys

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quireflow.operators import detect as E
from quireflow.plans import fakes
from quireflow.plans.registry import InputError
from quireflow.plans.stages import page_pipeline
from quireflow.sources import datasource as D
from quireflow.sources.pages import read_pages, write_markdown
from quireflow.streaming.pages import process_batch, process_pages
from quireflow.tables import Tables, shared_root

DATA = "/root/testdata/sf0.001"
CONFIG = {"coarse_detector": {**fakes.CONFIG["coarse_detector"], "permissive": True}, **{k: v for k, v in fakes.CONFIG.items() if k != "coarse_detector"}}


@pytest.fixture(scope="module")
def pictures(spark):
    return [bytes(r.content) for r in fakes.pages(spark, DATA).orderBy("doc_id").limit(12).collect()]


@pytest.fixture(scope="module")
def texts(spark, pictures):
    """Each picture's text by itself."""
    pages = spark.createDataFrame([(str(k), p) for k, p in enumerate(pictures)], "doc_id string, content binary")
    got = {int(r.doc_id): r.markdown for r in page_pipeline(**fakes.CONFIG).run(pages).collect()}
    return [got.get(k, "") for k in range(len(pictures))]


# --- source ----------------------------------------------------------------------------------------------------------------


@given(st.integers(0, 40), st.integers(1, 12))
def test_page_ranges_part_a_file(pages, shares):
    assert [k for s in range(shares) for k in D.page_range(pages, s, shares)] == list(range(pages))


@given(st.sets(st.text("ab.", min_size=1, max_size=5)))
def test_document_names_are_unique(names):
    names = sorted(names)
    got = D.document_names(names)
    assert len(set(got)) == len(names) and all(g in (n, D.stem_of(n)) for g, n in zip(got, names, strict=True))
    assert D.document_names(["a.png", "a.jpg", "b.pdf", "c", "c.png", ".x"]) == ["a.png", "a.jpg", "b", "c", "c.png", ".x"]


def test_pages_of_files(spark, tmp_path, pictures):
    (tmp_path / "a.png").write_bytes(pictures[0])
    (tmp_path / "a.jpg").write_bytes(pictures[1])
    (tmp_path / "many.TIFF").write_bytes(b"\n".join(pictures[2:9]))
    (tmp_path / "b c%20.pdf").write_bytes(pictures[9])
    (tmp_path / "_hidden.png").write_bytes(b"x")
    (tmp_path / "other.txt").write_bytes(b"x")
    want = {("a.png", "a.png", 0, pictures[0]), ("a.jpg", "a.jpg", 0, pictures[1]), ("b c%20", "b c%20", 0, pictures[9]), *((f"many/{k}", "many", k, pictures[2 + k]) for k in range(7))}
    for size in (D.PARTITION_BYTES, 30_000, 1000):  # one task, several, and one for a page or less
        df = read_pages(spark, str(tmp_path), partition_bytes=size)
        assert {(r.doc_id, r.document, r.page_no, bytes(r.content)) for r in df.collect()} == want and df.count() == 10
    assert read_pages(spark, str(tmp_path), partition_bytes=30_000).rdd.getNumPartitions() > 3
    assert {r.document for r in read_pages(spark, f"file://{tmp_path}", names="file").collect()} == {"a.png", "a.jpg", "many.TIFF", "b c%20.pdf"}
    assert [r.document for r in read_pages(spark, str(tmp_path / "other.txt")).collect()] == ["other"]
    assert sorted(r.document for r in read_pages(spark, str(tmp_path / "a.*")).collect()) == ["a.jpg", "a.png"]
    (tmp_path / "empty").mkdir()
    assert read_pages(spark, str(tmp_path / "empty")).count() == 0
    with pytest.raises(InputError):
        read_pages(spark, str(tmp_path / "nothing"))


def test_splitters_by_suffix(spark, tmp_path):
    (tmp_path / "x.pdf").write_bytes(b"one|two|three")
    df = read_pages(spark, str(tmp_path), splitters={"pdf": lambda content: content.split(b"|")})
    assert [(r.page_no, bytes(r.content)) for r in df.orderBy("page_no").collect()] == [(0, b"one"), (1, b"two"), (2, b"three")]


def test_documents_of_several_pages_through_all_stages(spark, tmp_path, pictures, texts):
    (tmp_path / "a.png").write_bytes(pictures[0])
    (tmp_path / "a.jpg").write_bytes(pictures[1])
    (tmp_path / "many.tiff").write_bytes(b"".join(pictures[2:9]))
    got = {r.doc_id: r.markdown for r in page_pipeline(**fakes.CONFIG).run(read_pages(spark, str(tmp_path), partition_bytes=30_000)).collect()}
    want = {"a.png": texts[0], "a.jpg": texts[1], "many": "\n\n".join(t for t in texts[2:9] if t)}
    assert {k: v for k, v in got.items() if v} == {k: v for k, v in want.items() if v} and len(want["many"]) > 100


def test_errors_reach_the_end_of_a_permissive_run(spark, pictures, texts):
    rows = [("good", "d", 1, pictures[0]), ("bad", "d", 0, b"no picture"), ("alone", "e", 0, b"P5\n")]
    pages = spark.createDataFrame(rows, "doc_id string, document string, page_no int, content binary")
    got = {r.doc_id: (r.markdown, r.error) for r in page_pipeline(**CONFIG).run(pages.drop("document", "page_no")).collect()}
    assert got["good"] == (texts[0], None) and got["bad"][0] == "" and got["bad"][1] and got["alone"][1]
    got = {r.doc_id: (r.markdown, r.error) for r in page_pipeline(**CONFIG).run(pages).collect()}
    assert got["d"][0] == texts[0] and got["d"][1] and got["e"][0] == "" and got["e"][1]
    with pytest.raises(Exception, match="Netpbm|identify|PIL|picture"):
        page_pipeline(**fakes.CONFIG).run(pages).collect()


# --- sink ------------------------------------------------------------------------------------------------------------------


def tree(root):
    return {str(p.relative_to(root)): p.read_bytes() for p in sorted(root.rglob("*")) if p.is_file()}


def test_sink_writes_all_or_nothing(spark, tmp_path):
    root = tmp_path / "out"
    df = spark.createDataFrame([(k, f"text {k} é") for k in range(20)] + [(None, None), (100, "a/b")], "doc_id long, markdown string").withColumn("name", F.coalesce(F.when(F.col("doc_id") == 100, "x/y\n").otherwise(F.col("doc_id").cast("string")), F.lit("null")))
    assert write_markdown(df.repartition(5), str(root), doc="name") == 22
    old = tree(root)
    assert old["3/3.md"] == "text 3 é".encode() and old["null/null.md"] == b"" and old["x%2Fy%0A/x%2Fy%0A.md"] == b"a/b" and len(old) == 22

    def fails(batches):  # rows are on their way to files when the task ends
        for b in batches:
            yield b
        raise ValueError("no more")

    def dies(batches):
        for b in batches:
            yield b
        os._exit(3)

    new = spark.range(1000).selectExpr("cast(id AS string) AS doc_id", "'new' AS markdown").repartition(3)
    for broken in (fails, dies):
        with pytest.raises(Exception):  # noqa: B017, PT011
            write_markdown(new.unionByName(new.limit(400).mapInPandas(broken, new.schema)), str(root))
        assert tree(root) == old
    assert write_markdown(new, str(root), suffix="_x") == 1000 and {k: v for k, v in tree(root).items() if not k.endswith("_x.md")} == old


def test_a_batch_is_written_once(spark, tmp_path):
    df = spark.createDataFrame([("a", "one")], "doc_id string, markdown string")
    assert write_markdown(df, str(tmp_path), batch="7") == 1 and D.batch_done(str(tmp_path), "7") and not D.batch_done(str(tmp_path), "8")
    assert write_markdown(df.withColumn("markdown", F.lit("two")), str(tmp_path), batch="7") == 0 and (tmp_path / "a" / "a.md").read_text() == "one"


def test_writer_by_itself(tmp_path):
    """Two attempts of a task, of which one counts; then an abort."""
    import pyarrow as pa

    batch = lambda text: iter([pa.RecordBatch.from_pydict({"doc_id": ["a", "b"], "markdown": [text, None]})])
    w = D.MarkdownWriter({"path": str(tmp_path)}).prepare()
    w.write(batch("lost"))
    kept = w.write(batch("kept"))
    assert not (tmp_path / "a").exists() and w.write(iter([])) == D.Staged(None, 0)
    w.commit([kept, None, D.Staged(None, 0)])
    assert tree(tmp_path) == {"a/a.md": b"kept", "b/b.md": b""}
    again = D.MarkdownWriter({"path": str(tmp_path)}).prepare()
    again.abort([again.write(batch("gone"))])
    again.abort([])
    with pytest.raises(OSError):  # a task that outlives its job
        again.write(batch("late"))
    assert tree(tmp_path) == {"a/a.md": b"kept", "b/b.md": b""}


# --- streams ---------------------------------------------------------------------------------------------------------------


def test_streamed_files_equal_a_batch(spark, tmp_path, pictures):
    source, out, check = tmp_path / "in", tmp_path / "out", str(tmp_path / "check")
    source.mkdir()
    shared = shared_root(spark).removeprefix("file://").removeprefix("file:")
    before = set(os.listdir(shared)) if os.path.isdir(shared) else set()
    make = lambda: page_pipeline(**fakes.CONFIG)
    (source / "a.png").write_bytes(pictures[0])
    (source / "a.jpg").write_bytes(pictures[1])
    (source / "skip.txt").write_bytes(b"x")
    process_pages(spark, str(source), str(out), check, make).awaitTermination()
    assert len(tree(out)) == 3  # and the batch's mark
    (source / "many.tiff").write_bytes(b"".join(pictures[2:6]))
    (source / "blank.png").write_bytes(b"P5\n%d %d\n255\n" % (fakes.WIDTH, fakes.HEIGHT) + b"{}\n".ljust(fakes.WIDTH * fakes.HEIGHT, b"\x7f"))
    process_pages(spark, str(source), str(out), check, make, files_per_batch=1).awaitTermination()
    done = tree(out)
    assert len([k for k in done if k.startswith(".batches/")]) == 3
    want = {r.doc_id: r.markdown for r in make().run(read_pages(spark, str(source), names="file")).collect()}
    assert {k: v.decode() for k, v in done.items() if k.endswith(".md")} == {f"{n}/{n}.md": want.get(n, "") for n in ("a.png", "a.jpg", "many.tiff", "blank.png")}
    # nothing is left in the shared folder but what the comparison above wrote
    process_batch(spark.read.format("binaryFile").load(str(source)).where("path LIKE '%.png'"), 0, make, str(out))
    assert tree(out) == done
    process_batch(spark.read.format("binaryFile").load(str(source)).where("path LIKE '%.png'"), 99, make, str(out))
    assert {k: v for k, v in tree(out).items() if k != ".batches/99"} == done
    left = {x for x in os.listdir(shared) if x not in before} if os.path.isdir(shared) else set()
    assert len(left) <= 1


def test_tables_of_a_run_can_be_dropped(spark):
    tables = Tables(spark, "test")
    tables.cut(spark.range(3), "a")
    path = tables.root.removeprefix("file://").removeprefix("file:")
    assert os.path.isdir(path)
    tables.close()
    assert not os.path.exists(path)


# --- workers without the package -------------------------------------------------------------------------------------------

ELSEWHERE = """
import sys
sys.path.insert(0, {repo!r})
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local-cluster[1,2,1024]").config("spark.checkpoint.dir", "file://{shared}").config("spark.sql.shuffle.partitions", "2").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.executor.memory", "1g").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
from quireflow.plans import catalogue
for name in {names!r}:
    rows = catalogue.QUERIES[name](spark, {data!r}).count()
    print("DONE", name, rows, flush=True)
spark.stop()
"""


def test_queries_run_where_only_the_driver_has_the_package(tmp_path):
    """Executors in processes of their own, in another folder, with an empty path."""
    repo = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    names = ["greedy_links", "gutter_widen", "chain_walk_order", "xy_reading_order_grouped", "end_to_end_markdown"]
    (tmp_path / "shared").mkdir()
    code = ELSEWHERE.format(repo=repo, names=names, data=DATA, shared=tmp_path / "shared")
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"} | {"PYSPARK_PYTHON": sys.executable}
    got = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=600)
    assert [line.split()[1] for line in got.stdout.splitlines() if line.startswith("DONE")] == names, got.stderr[-3000:]


def test_netpbm_pages():
    grey, colour = b"P5\n2 3\n255\n" + bytes(6), b"P6 1 1 255\n" + bytes(3)
    assert D.netpbm_pages(grey + colour + b"\n" + grey) == [grey, colour, grey] and E.netpbm_size(colour) == len(colour)
    assert D.split_pages(b"other", "png", {}) == [b"other"] and np.array_equal(E.decode_netpbm(colour), np.zeros((1, 1, 3), np.uint8))
