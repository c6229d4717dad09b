"""Sources and streams."""

import gzip
import json
import urllib.error

import pytest
from pyspark.sql import functions as F

from lensgrove import schemas
from lensgrove.operators import catalog
from lensgrove.plans.queries import ORACLES, QUERIES
from lensgrove.sources import files, paged
from lensgrove.streaming import ingest

from .oracle import assert_same


def test_dump(spark, tmp_path):
    with gzip.open(tmp_path / "t.tsv.gz", "wt") as f:
        f.write('taxon_id\tancestry\trank_level\trank\tname\tactive\n7\t1/2\t10\tspecies\t"Rosa ""x"" y"\ttrue\n8\t\t\t\tA\t\n')
    rows = files.read_dump(spark, str(tmp_path / "t.tsv.gz"), schemas.TAXA, 2).orderBy("taxon_id").collect()
    assert rows[0]["name"] == 'Rosa "x" y' and rows[1]["ancestry"] is None


def test_csv_round_trip(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'a "b", c\nd'), (2, None), (3, "")], "k int, v string")
    files.write_csv(rows, str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c"), rows.schema)
    assert {(r["k"], r["v"] or None) for r in back.collect()} == {(1, 'a "b", c\nd'), (2, None), (3, None)}
    assert files.read_csv(spark, str(tmp_path / "c"), rows.schema, ["k"]).columns == ["k"]


def test_csv_round_trip_keeps_ends_and_controls(spark, tmp_path):
    odd = [" a", "a ", "\ta\t", " ", "\n", "\n\na\n", "\r", " \ra", "\x00", "a\x00b", '"\x00"', 'a\x00\x00"b,"\n', "\x01 \x1f", "\x85x\u2028", "#a", "\\", '\\"', '"', ",", "\ufeffa", "x" * 2_000_000]
    rows = spark.createDataFrame([(2 * k + j, v + end) for k, v in enumerate(odd) for j, end in enumerate(("", '", "'))], "k int, v string")
    files.write_csv(rows, str(tmp_path / "c"))
    assert dict(files.read_csv(spark, str(tmp_path / "c"), rows.schema).collect()) == dict(rows.collect())


def test_csv_query_keeps_white_space(spark, tmp_path):
    spark.createDataFrame([(1, " a"), (2, "\n\tb "), (3, None), (4, "\rc"), (5, "\x00")], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert_same(QUERIES["csv_round_trip"](spark, str(tmp_path)), ORACLES["csv_round_trip"], tmp_path)


def test_index_lookup_prunes(spark, tmp_path):
    path = str(tmp_path / "index")
    rows = spark.range(2000).select((F.col("id") % 50).cast("int").alias("taxon_id"), F.col("id").alias("photo_id"), F.lit("jpg").alias("extension"))
    files.write_index(rows, path, row_group=500)
    files.write_index(rows.limit(0), path)  # it exists: left alone
    found = catalog.look_up(files.read_index(spark, path), 7, "photo_id")
    assert [r[0] for r in found.collect()] == list(range(7, 2000, 50))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(taxon_id,7)" in plan and "extension" not in plan.split("ReadSchema")[1].split("\n")[0]


def test_json_log_and_census(spark, tmp_path):
    (tmp_path / "r.json").write_text(json.dumps({"tar_bytes": 5, "remote_subpath": "x"}, indent=2))
    assert files.read_json(spark, str(tmp_path / "r.json"), schemas.RECEIPT).first()["present"] is True
    assert files.read_json(spark, str(tmp_path / "none.json"), schemas.RECEIPT).first()["present"] is False
    (tmp_path / "log").write_bytes(b"a\nb\xff\n")
    assert files.read_log(spark, str(tmp_path / "log")).count() == 1
    (tmp_path / "masks/b").mkdir(parents=True)
    (tmp_path / "masks/b/x.npy").write_bytes(b"123")
    (tmp_path / "masks/b/x.txt").write_bytes(b"1")
    got = {r["kind"]: (r["files"], r["bytes"]) for r in files.census(spark, str(tmp_path), {"masks": ("masks", "*.npy"), "overlays": ("overlays", "*.png")}).collect()}
    assert got == {"masks": (1, 3), "overlays": (0, 0)}
    wanted = spark.createDataFrame([("a",), ("b",)], "path string")
    states = files.download_states(wanted, spark.createDataFrame([("a", 4), ("b", 0)], "path string, length bigint"))
    assert {tuple(r) for r in states.collect()} == {("a", "exists"), ("b", "missing")}


def test_census_lists_folders_in_tasks(spark, tmp_path):
    for k, folder in enumerate(("", "a", "a/deep", "b", "_hidden", "k=_v", "a/.x")):
        (tmp_path / "m" / folder).mkdir(parents=True, exist_ok=True)
        for n in range(40):
            (tmp_path / "m" / folder / f"f{n}.npy").write_bytes(b"x" * (k + 1))
        for name in ("_f.npy", ".f.npy", "f.npyx", "é[1].png", "f.npy.0.part"):
            (tmp_path / "m" / folder / name).write_bytes(b"yy")
    patterns = [None, "*.npy", "f?.npy", "f[0-2]*.npy", "*.{npy,png}", "é*"]
    got = files.census(spark, str(tmp_path), {str(k): ("m", p) for k, p in enumerate(patterns)} | {"none": ("n", None)})
    want = {(str(k), *files.read_binary(spark, str(tmp_path / "m"), p).agg(F.count("path"), F.coalesce(F.sum("length"), F.lit(0))).first()) for k, p in enumerate(patterns)}
    assert {tuple(r) for r in got.collect()} == want | {("none", 0, 0)}
    assert got.dtypes == [("kind", "string"), ("files", "bigint"), ("bytes", "bigint")]
    assert "binaryFile" not in got._jdf.queryExecution().optimizedPlan().toString()


def write_pages(path, n=25):
    rows = [{"id": k, "quality_grade": "research", "taxon": {"id": 1, "name": "Rosa canina"} if k % 2 else None, "photos": [[], None, [{"id": k * 10, "url": "http://h/square.jpg"}, {"id": k * 10 + 1, "url": None}]][k % 3]} for k in range(1, n + 1)]
    path.write_text("\n".join(json.dumps(r) for r in rows))


def test_paged_source(spark, tmp_path):
    write_pages(tmp_path / "o.jsonl")
    paged.register(spark)
    rows = spark.read.format("paged_observations").option("path", str(tmp_path / "o.jsonl")).option("perPage", "10").load()
    got = rows.orderBy("id").collect()
    assert [r["id"] for r in got] == list(range(1, 26)) and {r["page"] for r in got} == {1, 2, 3}
    flat = ingest.photo_rows(rows)
    assert flat.count() == 17 + 8 * 2  # a row for each observation without photos
    assert spark.read.format("paged_observations").option("path", str(tmp_path / "o.jsonl")).option("idAbove", "20").load().count() == 5
    assert paged.resume_cursor(flat) == 25
    assert paged.resume_cursor(flat.limit(0)) == 0


def test_pages_read_the_file_once(spark, tmp_path, monkeypatch):
    """By lines parsed: each page used to parse the whole file."""
    (tmp_path / "o").mkdir()
    ids = [k * 7919 % 3001 for k in range(3001)]  # 0 to 3000 in no order, over three files
    for k in range(3):
        (tmp_path / "o" / f"part-{k}.txt").write_text("".join(json.dumps({"id": i, "user": {"login": "\u00e9\u2028"}}) + "\n\n" for i in ids[k::3]), encoding="utf-8")
    (tmp_path / "o" / "_SUCCESS").write_text("")
    parsed, loads = [], json.loads
    monkeypatch.setattr(paged.json, "loads", lambda x: parsed.append(1) or loads(x))
    t = paged.FileTransport(str(tmp_path / "o"))
    got = list(paged.pages(t, 0, 7))
    assert [r["id"] for _, rows in got for r in rows] == list(range(1, 3001)) and [n for n, _ in got] == list(range(1, 430))
    assert len(parsed) == 3001 + 3000
    parts = t.parts(10, 7, 100)
    assert [(n, [r["id"] for r in rows]) for p in parts for n, rows in p] == [(n, [r["id"] for r in rows]) for n, rows in paged.pages(t, 10, 7)]
    assert len(parts) == 29 and max(len(p.at) for p in parts) == 105
    paged.register(spark)
    rows = spark.read.format("paged_observations").option("path", str(tmp_path / "o")).option("perPage", "7").option("idAbove", "10").load()
    assert [tuple(r) for r in rows.select("page", "pos", "id", "user.login").orderBy("id").collect()] == [(k // 7 + 1, k % 7, k + 11, "\u00e9\u2028") for k in range(2990)]
    assert spark.read.format("paged_observations").option("path", str(tmp_path / "o")).option("idAbove", "3000").load().count() == 0


def test_stream_reads_the_file_once(tmp_path, monkeypatch):
    """By lines parsed: each micro-batch used to parse the whole file for each of its pages. What is added later is seen."""
    write_pages(tmp_path / "o.jsonl", 1000)
    parsed, loads = [], json.loads
    monkeypatch.setattr(paged.json, "loads", lambda x: parsed.append(1) or loads(x))
    source = paged.PagedObservations({"path": str(tmp_path / "o.jsonl"), "perPage": "10", "pagesPerBatch": "2"})
    reader = source.simpleStreamReader(source.schema())

    def follow(at):
        while True:
            rows, end = reader.read(at)
            if end == at:
                return at
            rows = list(rows)
            got.extend(r[2] for r in rows)
            assert [r[2] for r in reader.readBetweenOffsets(at, end)] == [r[2] for r in rows]
            at = end

    got = []
    at = follow(reader.initialOffset())
    assert got == list(range(1, 1001)) and len(parsed) < 6 * 1000
    write_pages(tmp_path / "o.jsonl", 1100)
    follow(at)
    assert got == list(range(1, 1101))


def test_rows_that_share_an_id_are_on_one_page(tmp_path):
    (tmp_path / "o.jsonl").write_text("\n".join(json.dumps({"id": i, "n": n}) for n, i in enumerate([1, 2, 2, 2, 3, 3, None, 4])))
    t = paged.FileTransport(str(tmp_path / "o.jsonl"))
    assert [[r["n"] for r in rows] for _, rows in paged.pages(t, 0, 2)] == [[0, 1, 2, 3], [4, 5], [7]]
    assert [[r["n"] for r in rows] for p in t.parts(0, 2, 1) for _, rows in p] == [[0, 1, 2, 3], [4, 5], [7]]


def test_paged_stream_is_exactly_once(spark, tmp_path):
    write_pages(tmp_path / "o.jsonl", 12)

    def run():
        stream = ingest.read_pages(spark, path=str(tmp_path / "o.jsonl"), perPage="5")
        q = ingest.append_batches(stream, str(tmp_path / "out"), str(tmp_path / "cp"))
        try:
            q.processAllAvailable()
        finally:
            q.stop()
        return spark.read.parquet(str(tmp_path / "out")).select("observation_id").distinct().count()

    assert run() == 12
    write_pages(tmp_path / "o.jsonl", 20)
    assert run() == 20
    assert spark.read.parquet(str(tmp_path / "out")).count() == 20 + 7  # two photos for every third


class Answer:
    def __init__(self, data):
        self.data = data

    def __enter__(self):
        return self

    def __exit__(self, *a):
        pass

    def read(self):
        return self.data


def test_http_retries():
    waits, answers = [], [429, 503, None]

    def opener(request, timeout):
        code = answers.pop(0)
        if code:
            raise urllib.error.HTTPError(request.full_url, code, "x", {}, None)
        assert "id_above=7" in request.full_url
        return Answer(b'{"results": [{"id": 8}]}')

    t = paged.HttpTransport("http://h", {"taxon_id": "1"}, opener=opener, sleep=waits.append)
    assert t.page(7, 200) == [{"id": 8}] and waits == [10.0, 3.0]
    answers[:] = [404]
    with pytest.raises(urllib.error.HTTPError):
        t.page(7, 200)


def test_pages_stop_without_ids():
    class T:
        def page(self, above, n):
            return [{"id": 1}] if above == 0 else [{"x": 1}]

    assert [n for n, _ in paged.pages(T())] == [1, 2]


def test_ledger_counts_stream(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    got = ingest.ledger_counts(events.withColumn("ts", F.col("ts").cast("timestamp")))
    assert got.agg(F.sum("n")).first()[0] == events.count()
