"""Operators on small frames."""

import re
import time

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lensgrove import schemas
from lensgrove.config import RunConfig, variants
from lensgrove.operators import catalog, enrich, ledger, masks, metrics, receipt, report, worklist, writeback
from lensgrove.plans import images
from lensgrove.sources import png


def test_index_keeps_what_the_joins_keep(spark):
    photos = spark.createDataFrame([("1", "a", "jpg"), ("2", "a", None), ("3", "missing", "png"), ("4", "b", "png"), ("x", "c", "png"), ("5", None, "png")], "photo_id string, observation_uuid string, extension string")
    obs = spark.createDataFrame([("a", "7", "research", "1.5", ""), ("b", "7", "casual", "1", "2"), ("c", "007", "research", "x", "2")], "observation_uuid string, taxon_id string, quality_grade string, latitude string, longitude string")
    taxa = spark.createDataFrame([("7", "Rosa canina")], "taxon_id string, name string")
    rows = sorted(map(tuple, catalog.build_index(photos, obs, taxa).collect()), key=str)
    assert rows == sorted([(7, 1, "jpg", "Rosa canina", "research", 1.5, None), (7, 2, None, "Rosa canina", "research", 1.5, None), (7, None, "png", None, "research", None, 2.0)], key=str)
    with pytest.raises(ValueError, match="extension"):
        catalog.build_index(photos.drop("extension"), obs, taxa)
    with pytest.raises(catalog.NothingFound):
        catalog.must_have_rows(photos.limit(0), "taxon 1")


def test_global_index_counts_on_without_a_gap(spark):
    rows = spark.range(500).select((F.col("id") % 37).alias("k"), "id").union(spark.createDataFrame([(None, 500), (None, 501)], "k bigint, id bigint"))
    got = worklist.global_index(rows, ["k", "id"], ranges=8).orderBy("global_index").collect()
    assert [r["global_index"] for r in got] == list(range(1, 503))
    assert [(r["k"] is None, r["k"], r["id"]) for r in got] == sorted(((r["k"] is None, r["k"], r["id"]) for r in got), key=lambda x: (x[0], x[1] or 0, x[2]))
    assert worklist.global_index(rows.limit(0), ["k", "id"]).count() == 0


def test_shards_are_a_partition_of_the_list(spark):
    metadata = spark.createDataFrame([(str(k % 9), "Rosa canina", f"http://h/{k}.png" if k % 5 else "", k) for k in range(60)] + [("x", "Rosa", "http://h/1.jpg", 60)], "observation_id string, taxon_name string, photo_url string, source_pos int")
    whole = worklist.build_worklist(metadata, "/b", RunConfig(batch_size=10))
    parts = [worklist.build_worklist(metadata, "/b", RunConfig(batch_size=10, shard=s, num_shards=3)) for s in range(3)]
    key = lambda df: sorted((r["global_index"], r["batch_name"], r["image_name"]) for r in df.collect())
    assert key(worklist.union_all(parts)) == key(whole)
    assert len(key(whole)) == 48
    assert all(b == f"batch_{(g - 1) // 10 + 1:05d}" for g, b, _ in key(whole))


def test_resume_leaves_done_work_out(spark):
    work = spark.createDataFrame([(k,) for k in range(1, 11)] + [(None,)], "global_index bigint")
    rows = spark.createDataFrame([(1, "ok"), (1, "ok"), (2, "dl_failed"), (3, "strange"), (None, "ok")], "global_index bigint, status string")
    done = worklist.done_keys(rows)
    assert sorted(r[0] for r in done.collect()) == [1, 2]
    left = worklist.remaining(work, done)
    assert left.count() == 9
    assert sorted(r[0] for r in worklist.limited(work, done, 3, "remaining").collect()) == [3, 4, 5]
    assert sorted(r[0] for r in worklist.limited(work, done, 3, "total").collect()) == [3]
    assert [r[0] for r in worklist.done_keys(rows, retry_failed=True).collect()] == [1]


def test_ledger_appends_merges_and_renders(spark, tmp_path):
    path = str(tmp_path / "ledger")
    assert ledger.read_ledger(spark, path).count() == 0
    rows = spark.createDataFrame([(0, 1, "seg_failed", " bad "), (0, 2, "ok", None)], "shard int, global_index bigint, status string, error string")
    ledger.append(rows, path)
    again = spark.createDataFrame([(0, 1, "ok", [0.90625, 0.5])], "shard int, global_index bigint, status string, mask_scores array<double>")
    ledger.append(again, path)
    all_rows = ledger.read_ledger(spark, path)
    assert all_rows.columns == schemas.LEDGER.names
    merged = ledger.merge([all_rows, all_rows])
    assert {(r["global_index"], r["status"]) for r in merged.collect()} == {(1, "ok"), (2, "ok")}
    assert {r["mask_scores"] for r in ledger.render(merged).collect()} == {"0.9062,0.5000", None}
    assert [r[0] for r in ledger.errors(all_rows).collect()] == ["[SEG_FAIL] 1 bad"]
    assert ledger.counters(merged).first()["n_ok"] == 2


def test_write_back(spark):
    meta = spark.createDataFrame([(1, 1, "u", "old"), (2, 1, "v", "old"), (None, 1, "w", None)], "observation_id bigint, image_index bigint, photo_url string, avg_rgb string")
    done = spark.createDataFrame([(1, 1, "u", "(1,2,3)", "ok"), (2, 1, "v", "x", "seg_failed"), (None, 1, "w", "n", "ok")], "observation_id bigint, image_index bigint, photo_url string, avg_rgb string, status string")
    got = {(r["observation_id"], r["avg_rgb"]) for r in writeback.write_back(meta, done).collect()}
    assert got == {(1, "(1,2,3)"), (2, None), (None, "n")}
    assert writeback.write_back(meta.drop("image_index"), done).columns == ["observation_id", "photo_url", "avg_rgb"]


def test_replace_a_table_that_is_being_read(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(3).write.parquet(path)
    writeback.replace_table(spark, spark.read.parquet(path).withColumn("x", F.col("id") * 2), path)
    assert spark.read.parquet(path).columns == ["id", "x"]
    (tmp_path / "t").rename(tmp_path / "t.old")  # cut off between the renames
    writeback.recover_table(spark, path)
    assert spark.read.parquet(path).count() == 3


def test_masks():
    rgb = np.zeros((4, 3, 3), np.uint8)
    rgb[0, 0] = (200, 0, 0)
    rgb[3, 1:] = (0, 255, 0)
    found = masks.by_confidence(masks.ColourSegmenter().segment(rgb, "flower"))
    assert [round(s, 3) for _, s in found] == [1.0, 0.784]
    assert masks.bounding_box(found[0][0]) == {"x1": 1, "y1": 3, "x2": 2, "y2": 3}
    assert masks.average_rgb(rgb, found[1][0]) == {"r": 200, "g": 0, "b": 0}
    empty = np.zeros((4, 3), np.uint8)
    assert masks.bounding_box(empty) is None and masks.average_rgb(rgb, empty) is None and masks.cutout(rgb, empty) is None
    assert masks.resized(np.eye(2, dtype=np.uint8), 4, 4).sum() == 8
    half = np.zeros((1, 2, 3), np.uint8)
    half[0, 1] = (5, 1, 3)
    assert masks.average_rgb(half, np.ones((1, 2))) == {"r": 2, "g": 0, "b": 2}
    image, drawn = masks.overlay(rgb, [found[0][0], empty])
    assert drawn == 1 and png.decode(image).shape == (4, 3, 3)
    labelled = np.zeros((40, 60, 3), np.uint8)
    spot = np.zeros((40, 60), np.uint8)
    spot[35:, :8] = 1
    plain, marked = (png.decode(masks.overlay(labelled, [spot], x)[0]) for x in (None, ["a 0.9"]))
    assert (plain != marked).any() and (png.decode(masks.overlay(labelled, [])[0]) > 0).any()
    assert (masks.load_mask(enrich.npy(spot)) == spot).all()
    crop = png.decode(masks.cutout(rgb, found[0][0]))
    assert crop.shape == (1, 2, 4) and (crop[..., 3] == 255).all()


@given(st.integers(1, 9), st.integers(1, 9), st.sampled_from([1, 3, 4]), st.integers(0, 2**32 - 1))
@settings(max_examples=30, deadline=None)
def test_png_round_trip(h, w, c, seed):
    a = np.random.default_rng(seed).integers(0, 256, (h, w, c), np.uint8)
    assert (png.decode(png.encode(a if c > 1 else a[..., 0])) == a).all()


def test_spark_reads_our_png(spark, tmp_path):
    rgb = np.arange(36, dtype=np.uint8).reshape(3, 4, 3)
    (tmp_path / "a.png").write_bytes(png.encode(rgb))
    row = spark.read.format("image").load(str(tmp_path)).select("image.height", "image.width", "image.data").first()
    assert (row["height"], row["width"]) == (3, 4)
    assert (np.frombuffer(row["data"], np.uint8).reshape(3, 4, 3)[..., ::-1] == rgb).all()


class Broken:
    def segment(self, rgb, prompt):
        raise RuntimeError("no model")


def test_enrichment_isolates_failures(spark, tmp_path):
    rows = spark.createDataFrame([(1, [0.0] * 64), (2, [0.5] * 64)], "vec_id bigint, embedding array<float>")
    pictures = images.pictures(rows).unionByName(spark.createDataFrame([(3, b"junk", "batch_00001", "v_3", "masks/batch_00001"), (4, None, "batch_00001", "v_4", "masks/batch_00001")], "global_index bigint, content binary, batch_name string, stem string, mask_batch_relpath string"))
    config = RunConfig(score_threshold=0.3, cutouts=True)
    done = enrich.segment(pictures, config=config).cache()
    got = {r["global_index"]: r for r in enrich.ledger_rows(done, config).collect()}
    assert [got[k]["status"] for k in (1, 2, 3, 4)] == ["ok", "ok", "seg_failed", "dl_failed"]
    assert [got[k]["num_instances"] for k in (1, 2, 3, 4)] == [0, 1, 0, 0]
    assert all(len(r["mask_files"]) == len(r["mask_scores"]) == r["num_instances"] for r in got.values())
    assert got[2]["mask_files"] == ["masks/batch_00001/v_2_instance_0.npy"]
    for _ in range(2):  # again: the same files
        wrote = enrich.write_artefacts(done, str(tmp_path)).agg(F.sum("files")).first()[0]
    assert wrote == 4 == sum(1 for p in tmp_path.rglob("*") if p.is_file())
    assert {r["status"] for r in enrich.segment(pictures.where("global_index < 3"), Broken()).collect()} == {"seg_failed"}


def test_fetch_reads_what_is_there(spark, tmp_path):
    (tmp_path / "a").write_bytes(b"here")
    (tmp_path / "b").write_bytes(b"")
    work = spark.createDataFrame([(str(tmp_path / "a"), "u1"), (str(tmp_path / "b"), "u2"), (None, "bad")], "image_path string, photo_url string")

    def get(url):
        if url == "bad":
            raise OSError("gone")
        return url.encode()

    got = {r["photo_url"]: (r["download"], r["content"], r["download_error"]) for r in enrich.fetch(work, get).collect()}
    assert got["u1"][:2] == ("exists", bytearray(b"here")) and got["u2"][:2] == ("downloaded", bytearray(b"u2"))
    assert got["bad"] == ("dl_failed", None, "OSError: gone")


def test_jpeg_is_fetched_kept_decoded_and_segmented(spark, tmp_path):
    jvm = spark._jvm
    made = jvm.java.awt.image.BufferedImage(64, 48, 1)
    for y in range(48):
        for x in range(64):
            made.setRGB(x, y, 0xC81414 if 16 <= x < 48 and 16 <= y < 32 else 0x5A5A5A)
    out = jvm.java.io.File(str(tmp_path / "source.jpg"))
    assert jvm.javax.imageio.ImageIO.write(made, "jpg", out)
    photo = (tmp_path / "source.jpg").read_bytes()
    base = str(tmp_path / "run")
    work = spark.createDataFrame([(k, f"u{k}", f"{base}/images/b/{k}.jpg", "b", f"v_{k}", "masks/b") for k in (1, 2)], "global_index bigint, photo_url string, image_path string, batch_name string, stem string, mask_batch_relpath string")

    def get(url, photo=photo):
        return photo if url == "u1" else b"no image"

    config = RunConfig(score_threshold=0.3)
    for state in ("downloaded", "exists"):
        got = enrich.fetch(work, get, config).drop("content")
        got.write.mode("overwrite").parquet(str(tmp_path / state))
        got = spark.read.parquet(str(tmp_path / state))
        assert {r["download"] for r in got.collect()} == {state}
    rows = {r["global_index"]: r for r in enrich.ledger_rows(enrich.segment(enrich.with_images(got, base), config=config), config).collect()}
    assert (rows[1]["status"], rows[1]["num_instances"], rows[2]["status"]) == ("ok", 1, "dl_failed")
    c = rows[1]["avg_rgb"][0]
    assert abs(c["r"] - 200) < 12 and abs(c["g"] - 20) < 12


def test_slices_are_bounded(spark, monkeypatch):
    monkeypatch.setattr(enrich, "SLICE_BYTES", 10)
    b = [pd.DataFrame({"k": range(7), "photo_url": [f"u{k}" for k in range(7)]})]
    sizes = []

    class Frame:
        schema = spark.createDataFrame([(1, "u")], "k bigint, photo_url string").schema
        columns = ["k", "photo_url"]

        def mapInPandas(self, run, schema):
            got = list(run(iter(b)))
            sizes.extend(map(len, got))
            return pd.concat(got)

    got = enrich.fetch(Frame(), lambda u: b"12345")
    assert sorted(got["k"]) == list(range(7)) and max(sizes) == 2


def test_receipt_of_an_upload(spark, tmp_path):
    (tmp_path / "run/a").mkdir(parents=True)
    (tmp_path / "run/a/x.npy").write_bytes(b"123")
    row = receipt.send(spark, str(tmp_path / "run"), str(tmp_path / "run.tar"), "file://" + str(tmp_path / "share"), "s", str(tmp_path / "receipt.json")).first()
    assert row["tar_bytes"] == (tmp_path / "share/s/run.tar").stat().st_size and row["remote_listing"] == "run.tar"
    with pytest.raises(ValueError):
        enrich.write_atomic("s3a://bucket/x", b"")


def test_prefetch_is_bounded():
    running, most = [0], [0]

    def job(k):
        running[0] += 1
        most[0] = max(most[0], running[0])
        time.sleep(0.002)
        running[0] -= 1
        return k

    assert sorted(r for _, r, _ in enrich.prefetched(list(range(40)), job, 3, 6)) == list(range(40))
    assert most[0] <= 3


def test_checks_are_gated(spark):
    def fails():
        raise ValueError("no")

    got = report.run_checks([("env", lambda: report.environment(), None), ("net", fails, "env"), ("model", dict, "net"), ("run", dict, "model")])
    assert [r["status"] for r in got] == ["ok", "failed", "skipped", "skipped"]
    assert report.exit_status(got) == 1 and report.exit_status(got[:1]) == 0
    frame = report.checks_frame(spark, got, 1.0, 2.5)
    assert frame.first()["all_ok"] is False and frame.schema == schemas.CHECK_RUN


LOG = """000 (12.000.000) 2024-05-01 10:00:00 Job submitted from host
001 (12.000.000) 2024-05-01 10:03:38 Job executing on host
...
012 (12.000.000) 2024-05-01 10:04:00 Job was held.
\tdisk full
001 (12.000.000) 2024-05-01 10:05:00 Job executing on host
005 (12.000.000) 2024-05-01 10:13:38 Job terminated.
\t(1) Normal termination (return value 3)
"""


def test_job_log_and_report(spark):
    from lensgrove.sources.files import read_json

    logs = spark.createDataFrame([("a", LOG), ("b", ""), ("c", None)], "path string, text string")
    got = {r["path"]: r for r in report.job_summary(logs).collect()}
    assert (got["a"]["wait_s"], got["a"]["run_s"], got["a"]["exit_code"], got["a"]["hold_reason"], got["a"]["n_events"]) == (218.0, 600.0, 3, "disk full", 5)
    assert (got["b"]["wait_s"], got["b"]["exit_code"]) == (None, None)
    checks = report.checks_frame(spark, report.run_checks([("env", dict, None)]), 0.0, 1.0).withColumn("present", F.lit(True))
    text = report.report(report.job_summary(logs.where("path = 'a'")), checks, read_json(spark, "/nonexistent.json", schemas.RECEIPT)).first()[0]
    assert "waited 218.0 s" in text and "PASS env" in text and "no receipt" in text and "held: disk full" in text


def test_kpis(spark):
    rows = spark.createDataFrame([(1, [0.9, 0.8]), (1, []), (2, None), (3, [0.7])], "observation_id int, scores array<double>")
    got = {r["metric"]: r["value"] for r in metrics.kpis(rows, 10.0, 4.0).collect()}
    assert len(got) == 19
    assert (got["images"], got["with_detection"], got["masks"], got["observations"]) == (4, 2, 3, 3)
    assert got["mean_score"] == pytest.approx(0.8) and got["median_score"] == pytest.approx(0.8) and got["mean_score_per_observation"] == pytest.approx((0.85 + 0.7) / 2)
    none = {r["metric"]: r["value"] for r in metrics.kpis(rows.limit(0), 0.0, 0.0).collect()}
    assert none["images"] == 0 and none["images_per_s"] is None


def test_transfer_metrics(spark, tmp_path):
    spark.range(10).write.parquet(str(tmp_path / "x"))
    assert metrics.folder_bytes(spark, str(tmp_path / "x")) > 0
    assert metrics.transfer_metrics(2_000_000, 4.0)["mb_per_s"] == 0.5 and metrics.transfer_metrics(1, 0)["mb_per_s"] is None


def test_config():
    assert variants()["cutouts"].prefetch == 8
    with pytest.raises(ValueError):
        RunConfig(limit_scope="some")


@pytest.mark.parametrize("kind", ["bigint", "decimal(12,2)", "double"])
def test_global_index_of_skewed_and_null_values(spark, kind):
    values = [None, None, 5, 5, 5, 5, -3, 0, 10**6, *range(700), *[7] * 300]
    rows = spark.createDataFrame([(v, n) for n, v in enumerate(values)], "v long, n int").repartition(5).select(F.col("v").cast(kind).alias("v"), "n")
    want = [n for n, v in sorted(enumerate(values), key=lambda x: (x[1] is None, x[1] or 0, x[0]))]
    for ranges in (1, 2, 5, 256, 300):
        got = {r["global_index"]: r["n"] for r in worklist.global_index(rows, ("v", "n"), ranges=ranges).collect()}
        assert [got[k] for k in range(1, len(values) + 1)] == want
    for k in (0, 1, 2):  # no edge, or one
        assert worklist.global_index(rows.where("v is null" if k == 1 else "v = 5").limit(k), ("v", "n")).count() == k


def test_global_index_is_compiled(spark, capsys):
    """Methods of over 8000 bytes are interpreted; the search of 255 edges was one expression."""
    spark.conf.set("spark.sql.adaptive.enabled", False)  # else only what has run is compiled
    try:
        worklist.global_index(spark.range(3000).select((F.col("id") * 7 % 1009).alias("a"), "id"), ("a", "id")).explain("codegen")
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    sizes = [int(x) for x in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000


def test_names_are_made_after_sharding(spark):
    rows = spark.range(30).select(F.col("id").alias("observation_id"), F.when(F.col("id") % 2 == 0, "Rosa Canina").otherwise("rosa canina").alias("taxon_name"), F.lit("http://h/a.png").alias("photo_url"), F.col("id").alias("source_pos"))
    work = worklist.build_worklist(rows, "/b", RunConfig(shard=1, num_shards=3))
    assert {(r["global_index"], r["genus_species"]) for r in work.collect()} == {(k, "Rosa_canina") for k in range(1, 31, 3)}
    plan = work._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("genus_species") < plan.index("row_number") and "genus_species" not in plan.split("row_number", 1)[1]


def test_artefacts_are_written_together(tmp_path, monkeypatch):
    """The first file is synced when all are written, and gets its name when it is synced."""
    seen, sync = [], enrich.os.fsync
    monkeypatch.setattr(enrich.os, "fsync", lambda f: (seen.append(sorted(p.stat().st_size for p in tmp_path.rglob("*.part"))), sync(f)))
    enrich.write_all([(f"file://{tmp_path}/d{k}/f", b"x" * 10 * k) for k in range(3)])
    assert seen == [[0, 10, 20], [10, 20], [20]]
    assert {p.parent.name: p.read_bytes() for p in tmp_path.rglob("*") if p.is_file()} == {f"d{k}": b"x" * 10 * k for k in range(3)}
    enrich.write_all([])


def test_pictures_are_parted_by_rows(spark, monkeypatch):
    monkeypatch.setattr(images, "PART_ROWS", 100)
    rows = spark.range(450).select(F.col("id").alias("vec_id"), F.array(F.lit(0.5)).alias("embedding")).coalesce(1)
    made = images.pictures(rows)
    assert made.rdd.getNumPartitions() == 5 and made.select("global_index").distinct().count() == 450
    assert images.pictures(rows.limit(0)).count() == 0


def test_slices_of_artefacts(spark, tmp_path, monkeypatch):
    """Files are counted and written whole whatever the slices."""
    rows = enrich.segment(images.pictures(spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").limit(30)), config=RunConfig(cutouts=True, score_threshold=0.0))
    got = []
    for n in (1, 7, 256):
        monkeypatch.setattr(enrich, "SLICE_FILES", n)
        wrote = {tuple(r) for r in enrich.write_artefacts(rows, str(tmp_path / str(n))).collect()}
        there = [p for p in (tmp_path / str(n)).rglob("*") if p.is_file()]
        assert len(there) == sum(r[1] for r in wrote) and sum(p.stat().st_size for p in there) == sum(r[2] for r in wrote)
        got.append(wrote)
    assert got[0] == got[1] == got[2]
