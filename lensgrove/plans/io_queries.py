"""Registered queries of sources, sinks, image figures and reports, and their DuckDB SQL.

What a query writes and reads again lies in a new folder under the session's shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from lensgrove import functions as L
from lensgrove import schemas
from lensgrove.config import RunConfig
from lensgrove.functions.arrays import colours_text
from lensgrove.operators import catalog, enrich, ledger, masks, metrics, receipt, report, worklist, writeback
from lensgrove.sources import files, paged, png
from lensgrove.streaming import ingest

from . import images
from .queries import _BINOMIAL, _STAR, query, raw_star, table


def _stored(spark, df):
    """df done once, whatever reads it how often."""
    path = files.scratch(spark)
    df.write.parquet(path)
    return spark.read.parquet(path)


_LONG = """CASE event_id % 6 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN event_id::VARCHAR || '.0' WHEN 2 THEN '-' || event_id::VARCHAR || '.25'
           WHEN 3 THEN (event_id % 9)::VARCHAR || 'e3' WHEN 4 THEN '' ELSE 'x' || event_id::VARCHAR END"""


@query(f"SELECT event_id, CASE WHEN TRY_CAST(t AS DOUBLE) = floor(TRY_CAST(t AS DOUBLE)) THEN CAST(TRY_CAST(t AS DOUBLE) AS BIGINT) END AS n FROM (SELECT event_id, {_LONG} AS t FROM events)")
def to_long_column(spark, d):
    e, m = F.col("event_id").cast("string"), F.pmod("event_id", F.lit(6))
    t = F.when(m == 0, e).when(m == 1, F.concat(e, F.lit(".0"))).when(m == 2, F.concat(F.lit("-"), e, F.lit(".25")))
    t = t.when(m == 3, F.concat(F.pmod("event_id", F.lit(9)).cast("string"), F.lit("e3"))).when(m == 4, "").otherwise(F.concat(F.lit("x"), e))
    return table(spark, d, "events").select("event_id", L.to_long(t).alias("n"))


_META = """(SELECT l_orderkey AS observation_id, CASE WHEN l_linenumber <> 3 THEN l_linenumber END AS image_index,
            'u' || l_partkey::VARCHAR || '_' || l_suppkey::VARCHAR AS photo_url, l_quantity AS q FROM lineitem)"""


@query(f"""SELECT m.observation_id, m.image_index, m.photo_url, l.avg_rgb FROM {_META} m LEFT JOIN (SELECT DISTINCT observation_id, image_index, photo_url, '(1,2,3)' AS avg_rgb FROM {_META} WHERE q > 25) l
           ON m.observation_id = l.observation_id AND m.image_index IS NOT DISTINCT FROM l.image_index AND m.photo_url = l.photo_url""")
def writeback_three_keys(spark, d):
    rows = table(spark, d, "lineitem").select(
        F.col("l_orderkey").alias("observation_id"),
        F.when(F.col("l_linenumber") != 3, F.col("l_linenumber")).alias("image_index"),
        F.concat(F.lit("u"), F.col("l_partkey").cast("string"), F.lit("_"), F.col("l_suppkey").cast("string")).alias("photo_url"),
        F.when(F.col("l_quantity") > 25, "ok").otherwise("seg_failed").alias("status"),
    )
    done = rows.distinct().withColumn("avg_rgb", F.lit("(1,2,3)"))
    return writeback.write_back(rows.drop("status").withColumn("avg_rgb", F.lit("old")), done)


@query(_STAR + "SELECT photo_id, extension, taxon_name, latitude FROM idx WHERE taxon_id = 37")
def index_write_lookup(spark, d):
    """The index is written, range-partitioned and sorted, and read again with the taxon pushed into the scan."""
    path = files.scratch(spark)
    files.write_index(catalog.build_index(*raw_star(spark, d)), path)
    return catalog.look_up(files.read_index(spark, path), 37, "photo_id", "extension", "taxon_name", "latitude")


@query(_STAR + "SELECT count(*) AS n_rows, count(DISTINCT taxon_id) AS n_taxa, min(photo_id) AS least, max(photo_id) AS most FROM idx")
def index_read(spark, d):
    path = files.scratch(spark)
    files.write_index(catalog.build_index(*raw_star(spark, d)), path)
    return files.read_index(spark, path, ["taxon_id", "photo_id"]).agg(F.count("*").alias("n_rows"), F.count_distinct("taxon_id").alias("n_taxa"), F.min("photo_id").alias("least"), F.max("photo_id").alias("most"))


@query("SELECT p_partkey::VARCHAR AS taxon_id, CASE WHEN p_partkey % 5 <> 0 THEN p_name || ' \"x\"' END AS name FROM part")
def dump_read(spark, d):
    path = files.scratch(spark)
    name = F.when(F.pmod("p_partkey", F.lit(5)) != 0, F.concat("p_name", F.lit(' "x"')))
    rows = table(spark, d, "part").select(F.col("p_partkey").cast("string").alias("taxon_id"), *[F.lit(None).cast("string").alias(n) for n in ("ancestry", "rank_level", "rank")], name.alias("name"), F.lit("true").alias("active"))
    rows.write.csv(path, sep="\t", header=True, escape='"', quote='"', compression="gzip")
    return files.read_dump(spark, path, schemas.TAXA, 4).select("taxon_id", "name")


@query("SELECT doc_id, replace(text, chr(13), ' ') || '\", \"' AS text FROM documents")
def csv_round_trip(spark, d):
    path = files.scratch(spark)
    rows = table(spark, d, "documents").select("doc_id", F.concat(F.replace("text", F.lit("\r"), F.lit(" ")), F.lit('", "')).alias("text"), F.lit(1).alias("x"))
    files.write_csv(rows, path)
    return files.read_csv(spark, path, rows.schema, ["doc_id", "text"])


@query("SELECT count(*) AS tar_bytes, min(r_name) AS remote_subpath, true AS present, false AS other FROM region")
def json_document_read(spark, d):
    path = files.scratch(spark)
    files.write_json(table(spark, d, "region").agg(F.count("*").alias("tar_bytes"), F.min("r_name").alias("remote_subpath")), path)
    missing = files.read_json(spark, path + "-none", schemas.RECEIPT).select(F.col("present").alias("other"))
    return files.read_json(spark, path, schemas.RECEIPT).select("tar_bytes", "remote_subpath", "present").join(missing)


@query("SELECT event_type, string_agg(user_id::VARCHAR, chr(10) ORDER BY event_id) || chr(10) AS text FROM events GROUP BY event_type")
def log_read(spark, d):
    path = files.scratch(spark)
    logs = table(spark, d, "events").groupBy("event_type").agg(L.ordered_join(F.col("user_id").cast("string"), F.col("event_id"), "\n").alias("value"))
    logs.repartition("event_type").write.partitionBy("event_type").text(path)
    return files.read_log(spark, path + "/*/*.txt").select(F.regexp_extract("path", "event_type=([^/]+)", 1).alias("event_type"), "text")


_GRID = "(SELECT vec_id, i, i // 8 AS y, i % 8 AS x, embedding[i + 1]::DOUBLE AS v FROM (SELECT vec_id, embedding, unnest(range(64)) AS i FROM embeddings))"
_RED = "CAST(floor(least(255.0, greatest(0.0, 120 + v * 400))) AS INTEGER)"
_ROWS = f"""(SELECT vec_id, y, count(*) AS n, '(' || CAST(round_even(avg({_RED}), 0) AS INTEGER)::VARCHAR || ',20,20)' AS rgb, min(x) AS x1, max(x) AS x2 FROM {_GRID} WHERE v > 0.1 GROUP BY vec_id, y)"""
_FOUND = f"(SELECT *, row_number() OVER (PARTITION BY vec_id ORDER BY n DESC, y) - 1 AS k FROM {_ROWS} WHERE n >= 3)"


class RowSegmenter:
    """Each row of a picture() that has red pixels is an instance, scored by how many of its pixels are red."""

    def segment(self, rgb: np.ndarray, prompt: str) -> list[tuple[np.ndarray, float]]:
        red = rgb[..., 1] == 20
        out = []
        for y in np.flatnonzero(red.any(1)):
            m = np.zeros(red.shape, np.uint8)
            m[y] = red[y]
            out.append((m, float(red[y].mean())))
        return out


_CONFIG = RunConfig(score_threshold=3 / 8, cutouts=True)


def _enriched(spark, d):
    return enrich.segment(images.pictures(table(spark, d, "embeddings")), RowSegmenter(), _CONFIG)


def _artefacts(spark, d, base):
    """Artefacts in folders by batch: files of one folder are made one at a time, whatever the number of tasks."""
    return enrich.write_artefacts(_enriched(spark, d).withColumn("batch_name", L.batch_name(F.col("global_index") + 1, _CONFIG.batch_size)), base)


@query(f"""SELECT e.vec_id AS global_index, CAST(coalesce(f.n, 0) AS INTEGER) AS num_instances, coalesce(f.files, '') AS mask_files, coalesce(f.scores, '') AS mask_scores, coalesce(f.rgb, '') AS avg_rgb,
           'ok' AS status, CAST(NULL AS VARCHAR) AS error
           FROM embeddings e LEFT JOIN (SELECT vec_id, count(*) AS n, string_agg('masks/batch_00001/v_' || vec_id::VARCHAR || '_instance_' || k::VARCHAR || '.npy', ';' ORDER BY k) AS files,
             string_agg(printf('%.4f', n / 8.0), ',' ORDER BY k) AS scores, string_agg(rgb, ',' ORDER BY k) AS rgb FROM {_FOUND} GROUP BY vec_id) f ON e.vec_id = f.vec_id""")
def enrich_images(spark, d):
    """Small images made of embeddings, segmented by rows, reduced to ledger rows and rendered."""
    rows = enrich.ledger_rows(_enriched(spark, d), _CONFIG)
    return ledger.render(rows).select("global_index", "num_instances", "mask_files", "mask_scores", "avg_rgb", "status", "error")


@query(f"""SELECT e.vec_id AS global_index, CAST(2 * coalesce(f.n, 0) + 1 AS INTEGER) AS files, 192 * coalesce(f.n, 0) AS mask_bytes FROM embeddings e
           LEFT JOIN (SELECT vec_id, count(*) AS n FROM {_FOUND} GROUP BY vec_id) f ON e.vec_id = f.vec_id""")
def artefacts_written(spark, d):
    """Masks, cut-outs and overlays as files, counted from their names and sizes: an .npy of 8 x 8 has 192 bytes."""
    base = files.scratch(spark)
    wrote = _stored(spark, _artefacts(spark, d, base).select("global_index", "files"))
    masks_ = files.read_binary(spark, base + "/masks", "*.npy").groupBy(F.regexp_extract("path", "v_([0-9]+)_", 1).cast("long").alias("id")).agg(F.sum("length").alias("m"))
    return wrote.join(masks_, F.col("global_index") == F.col("id"), "left").select("global_index", "files", F.coalesce("m", F.lit(0)).alias("mask_bytes"))


@query(f"""SELECT 'masks' AS kind, count(*) AS files, 192 * count(*) AS bytes FROM {_FOUND} UNION ALL SELECT 'none', 0, 0""")
def file_census(spark, d):
    base = files.scratch(spark)
    _artefacts(spark, d, base).write.format("noop").mode("overwrite").save()
    return files.census(spark, base, {"masks": ("masks", "*.npy"), "none": ("nothing", "*.npy")})


_FIGURES = "n_pixels bigint, x1 int, y1 int, x2 int, y2 int, r int, g int, b int, wide_pixels bigint, wide_x2 int, wide_y2 int, any_set boolean, cut_w int, cut_h int, cut_alpha bigint, drawn int"


@query(f"""SELECT vec_id, count(*) AS n_pixels, CAST(min(x) AS INTEGER) AS x1, CAST(min(y) AS INTEGER) AS y1, CAST(max(x) AS INTEGER) AS x2, CAST(max(y) AS INTEGER) AS y2,
           CAST(round_even(avg({_RED}), 0) AS INTEGER) AS r, 20 AS g, 20 AS b, 6 * count(*) AS wide_pixels, CAST(2 * max(x) + 1 AS INTEGER) AS wide_x2, CAST(3 * max(y) + 2 AS INTEGER) AS wide_y2, true AS any_set,
           CAST(max(x) - min(x) + 1 AS INTEGER) AS cut_w, CAST(max(y) - min(y) + 1 AS INTEGER) AS cut_h, 255 * count(*) AS cut_alpha, 1 AS drawn
           FROM {_GRID} WHERE v > 0.1 GROUP BY vec_id""")
def mask_figures(spark, d):
    """What operators.masks makes of one mask a picture: binary, size, box, colour, resized, cut out, drawn, stored."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for vec, e in zip(b["vec_id"], b["embedding"]):
                v = np.resize(np.asarray(e, np.float64), 64).reshape(8, 8)
                rgb = png.to_rgb(png.decode(images.picture(e)))
                m = masks.load_mask(enrich.npy(masks.binary((v > 0.1)[None] * v[None])))
                if not m.any():
                    continue
                wide = masks.resized(m, 24, 16)
                box, big, c = masks.bounding_box(m), masks.bounding_box(wide), masks.average_rgb(rgb, m)
                cut = png.decode(masks.cutout(rgb, m))
                rows.append((vec, int(m.sum()), box["x1"], box["y1"], box["x2"], box["y2"], c["r"], c["g"], c["b"], int(wide.sum()), big["x2"], big["y2"], bool(m.any()), cut.shape[1], cut.shape[0], int(cut[..., 3].astype(int).sum()), masks.overlay(rgb, [m], ["x"])[1]))
            yield pd.DataFrame(rows, columns=["vec_id", *(x.split()[0] for x in _FIGURES.split(", "))])

    return table(spark, d, "embeddings").select("vec_id", "embedding").mapInPandas(run, "vec_id bigint, " + _FIGURES)


@query(f"""SELECT vec_id, CAST(8 AS INTEGER) AS height, CAST(8 AS INTEGER) AS width, CAST(sum(CASE WHEN v > 0.1 THEN {_RED} ELSE 90 END) AS BIGINT) AS red FROM {_GRID} GROUP BY vec_id""")
def image_decode(spark, d):
    """Picture files, decoded by Spark's image source in the JVM."""
    base = files.scratch(spark)
    work = images.pictures(table(spark, d, "embeddings")).select("global_index", F.concat(F.lit(enrich.local(base) + "/"), F.col("global_index").cast("string"), F.lit(".png")).alias("image_path"), F.lit("u").alias("photo_url"), "content")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for p, c in zip(b["image_path"], b["content"]):
                enrich.write_atomic(p, bytes(c))
            yield b[["global_index", "image_path"]]

    listed = _stored(spark, work.mapInPandas(write, "global_index bigint, image_path string"))

    @F.pandas_udf("bigint")
    def red(image: pd.DataFrame) -> pd.Series:
        return pd.Series([int(enrich.pixels(x)[..., 0].astype(int).sum()) for x in image.to_dict("records")])

    return enrich.with_images(listed, base).select(F.col("global_index").alias("vec_id"), "content.height", "content.width", red("content").alias("red"))


class _Getter:
    """Bodies by URL; every seventh page is gone."""

    def __call__(self, url: str) -> bytes:
        if int(url.rsplit("/", 1)[1]) % 7 == 0:
            raise OSError("gone")
        return url.encode()


@query("""SELECT page_id, CASE WHEN page_id % 7 = 0 THEN 'dl_failed' ELSE 'downloaded' END AS first, CASE WHEN page_id % 7 = 0 THEN 'dl_failed' ELSE 'exists' END AS second,
          CASE WHEN page_id % 7 <> 0 THEN CAST(length('http://h/' || page_id::VARCHAR) AS INTEGER) END AS bytes, CASE WHEN page_id % 7 = 0 THEN 'OSError: gone' END AS error FROM pages""")
def fetch_states(spark, d):
    """Everything is fetched and kept; a second run finds what the first one kept and tries the rest again."""
    base = enrich.local(files.scratch(spark))
    key = F.col("page_id").cast("string")
    work = table(spark, d, "pages").select("page_id", F.concat(F.lit("http://h/"), key).alias("photo_url"), F.concat(F.lit(base + "/"), key).alias("image_path"))
    runs = []
    for name in ("first", "second"):
        got = enrich.fetch(work, _Getter()).select("page_id", F.col("download").alias(name), F.length("content").alias("bytes"), F.col("download_error").alias("error"))
        runs.append(_stored(spark, got))
    return runs[0].select("page_id", "first").join(runs[1], "page_id")


_LEDGER = """(SELECT doc_id AS global_index, quality, toxic, CASE WHEN quality = 1 THEN 'ok' WHEN toxic = 1 THEN 'dl_failed' ELSE 'seg_failed' END AS status FROM labels)"""


def _ledger_rows(spark, d):
    status = F.when(F.col("quality") == 1, "ok").when(F.col("toxic") == 1, "dl_failed").otherwise("seg_failed")
    return table(spark, d, "labels").select(F.lit(0).alias("shard"), F.col("doc_id").alias("global_index"), status.alias("status"), F.when(status != "ok", F.concat(F.lit(" e"), F.col("doc_id").cast("string"))).alias("error"))


@query(f"""SELECT global_index, CASE WHEN global_index % 3 = 0 THEN 'ok' ELSE status END AS status FROM {_LEDGER}""")
def ledger_append_merge(spark, d):
    """A first run's rows, a retry's rows appended, and one row a key: the successful one if there is any."""
    path = files.scratch(spark)
    rows = _ledger_rows(spark, d)
    ledger.append(rows, path)
    ledger.append(rows.where(F.pmod("global_index", F.lit(3)) == 0).withColumn("status", F.lit("ok")), path)
    both = ledger.read_ledger(spark, path)
    return ledger.merge([both, ledger.read_ledger(spark, path + "-none")]).select("global_index", "status")


@query(f"SELECT (CASE status WHEN 'dl_failed' THEN '[DL_FAIL]' ELSE '[SEG_FAIL]' END) || ' ' || global_index::VARCHAR || ' e' || global_index::VARCHAR AS value FROM {_LEDGER} WHERE status <> 'ok'")
def ledger_errors(spark, d):
    return ledger.errors(_ledger_rows(spark, d))


@query(f"""SELECT count(*) AS n_rows, CAST(count_if(status = 'ok') AS BIGINT) AS n_ok, CAST(count_if(status = 'dl_failed') AS BIGINT) AS n_dl_failed, CAST(count_if(status = 'seg_failed') AS BIGINT) AS n_seg_failed, CAST(sum(toxic) AS BIGINT) AS n_instances FROM {_LEDGER}""")
def ledger_counters(spark, d):
    return ledger.counters(_ledger_rows(spark, d).join(table(spark, d, "labels").select(F.col("doc_id").alias("global_index"), F.col("toxic").alias("num_instances")), "global_index"))


@query("SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL")
def done_keys_retry(spark, d):
    return worklist.done_keys(_ledger_rows(spark, d), retry_failed=True).withColumnRenamed("global_index", "doc_id")


@query("""SELECT vec_id, string_agg('(' || i::VARCHAR || ',2,' || (i * 2)::VARCHAR || ')', ',' ORDER BY i) FILTER (WHERE i % 3 <> 0) AS colours, CAST(count_if(i % 3 <> 0) AS INTEGER) AS n
          FROM (SELECT vec_id, unnest(range(6)) AS i FROM embeddings) GROUP BY vec_id""")
def colours_without_nulls(spark, d):
    i = F.sequence(F.lit(0), F.lit(5))
    colours = F.transform(i, lambda k: F.when(k % 3 != 0, F.struct(k.alias("r"), F.lit(2).alias("g"), (k * 2).alias("b"))))
    return table(spark, d, "embeddings").select("vec_id", colours_text(colours).alias("colours"), F.size(L.drop_null_rgb(colours)).alias("n"))


_OBSERVED = "(SELECT conv_id, turn, role, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS pos FROM conversations)"


def _observations(spark, d):
    """JSON-lines files of observations made of conversations, in order of their ids: what a paged service would answer.

    Turns that are equal in turn and role give the same photo, so texts aren't read."""
    photo = F.struct((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), F.col("role").alias("url"))
    turns = table(spark, d, "conversations").select((F.col("conv_id") + 1).alias("id"), "turn", "role", photo.alias("p")).repartitionByRange("id")
    photos = F.transform(F.array_sort(F.collect_list(F.struct("turn", "role", "p"))), lambda x: x["p"])
    path = files.scratch(spark)
    observed = turns.groupBy("id").agg(photos.alias("photos")).sortWithinPartitions("id")
    observed.select(F.to_json(F.struct("id", F.lit("research").alias("quality_grade"), "photos")).alias("value")).write.text(path)
    return enrich.local(path)


_FLAT = "SELECT conv_id + 1 AS observation_id, 'research' AS quality_grade, CAST(pos AS INTEGER) AS photo_pos, conv_id * 1000 + turn AS photo_id, role AS photo_url"


@query(f"{_FLAT}, CAST((dense_rank() OVER (ORDER BY conv_id) - 1) // 40 + 1 AS INTEGER) AS page FROM {_OBSERVED}")
def paged_read(spark, d):
    """Pages of 40 observations behind a cursor, exploded to photos."""
    paged.register(spark)
    rows = spark.read.format("paged_observations").option("path", _observations(spark, d)).option("perPage", "40").load()
    return ingest.photo_rows(rows, "page").select("observation_id", "quality_grade", "photo_pos", "photo_id", "photo_url", "page")


@query(f"{_FLAT} FROM {_OBSERVED}")
def paged_stream(spark, d):
    """The same as a stream that appends its micro-batches to a table, stopped and started again on the way."""
    path, source = files.scratch(spark), _observations(spark, d)
    for _ in range(2):
        q = ingest.append_batches(ingest.read_pages(spark, path=source, perPage="150", pagesPerBatch="2"), path + "/t", path + "/cp")
        try:
            q.processAllAvailable()
        finally:
            q.stop()
    return spark.read.parquet(path + "/t").select("observation_id", "quality_grade", "photo_pos", "photo_id", "photo_url")


@query("SELECT CAST(coalesce(max(doc_id), 0) AS BIGINT) AS cursor FROM documents")
def resume_cursor(spark, d):
    at = paged.resume_cursor(table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("observation_id")))
    return spark.createDataFrame([(at,)], "cursor bigint")


_LISTED = f"""(SELECT *, CAST(row_number() OVER (PARTITION BY o ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS BIGINT) AS image_index, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS global_index
   FROM (SELECT l.*, l_orderkey AS o, p_name AS n FROM lineitem l JOIN part ON p_partkey = l_partkey WHERE l_orderkey % 10 <> 0 AND l_linenumber <> 5))"""


@query(f"""SELECT global_index, o AS observation_id, image_index, genus_species, b AS batch_name, stem || '.png' AS image_name, 'images/' || b || '/' || stem || '.png' AS image_relpath, 'masks/' || b AS mask_batch_relpath,
           'overlays/' || b || '/' || stem || '_overlay.png' AS overlay_relpath, '/base/images/' || b || '/' || stem || '.png' AS image_path, '/base/masks/' || b AS mask_dir,
           '/base/overlays/' || b || '/' || stem || '_overlay.png' AS overlay_path, '/base/images/' || b AS image_dir, '/base/overlays/' || b AS overlay_dir, '/base/segments/' || b AS segment_dir
           FROM (SELECT *, genus_species || '_' || o::VARCHAR || '_image' || image_index::VARCHAR AS stem FROM (SELECT *, {_BINOMIAL} AS genus_species, printf('batch_%05d', (global_index - 1) // 1000 + 1) AS b FROM {_LISTED}))
           WHERE global_index % 3 = 1""")
def worklist_build(spark, d):
    """The whole work-list: filled URLs, whole observation numbers, ordinals, indices, all names and paths, one shard of three."""
    number = F.when(F.pmod("l_orderkey", F.lit(10)) == 0, F.lit("n/a")).otherwise(F.concat(F.col("l_orderkey").cast("string"), F.lit(".0")))
    url = F.when(F.col("l_linenumber") == 5, "").otherwise("http://h/a.png")
    order = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")
    meta = table(spark, d, "lineitem").join(table(spark, d, "part").select("p_partkey", F.col("p_name").alias("taxon_name")), F.col("l_partkey") == F.col("p_partkey"))
    meta = meta.select(*order, "taxon_name", number.alias("observation_id"), url.alias("photo_url"))
    rows = worklist.build_worklist(meta, "/base", RunConfig(batch_size=1000, shard=1, num_shards=3, cutouts=True), order)
    return rows.select("global_index", "observation_id", "image_index", "genus_species", "batch_name", "image_name", "image_relpath", "mask_batch_relpath", "overlay_relpath", "image_path", "mask_dir", "overlay_path", "image_dir", "overlay_dir", "segment_dir")


@query("""SELECT 'missing' AS what, 'ValueError: missing columns: extension' AS outcome UNION ALL SELECT 'empty', 'NothingFound: no rows for taxon 0'
          UNION ALL SELECT 'filled', (SELECT min(r_regionkey)::VARCHAR FROM region) UNION ALL SELECT 'none', 'None'""")
def validation(spark, d):
    """What the checks of inputs say, and the first row of a frame, if there is one."""
    region = table(spark, d, "region").orderBy("r_regionkey")
    photos, observations, taxa = raw_star(spark, d)
    probes = {
        "missing": lambda: catalog.build_index(photos.drop("extension"), observations, taxa),
        "empty": lambda: catalog.must_have_rows(region.where("r_regionkey < 0"), "taxon 0"),
        "filled": lambda: catalog.first_row(catalog.must_have_rows(region, "regions"))["r_regionkey"],
        "none": lambda: catalog.first_row(region.where("r_regionkey < 0")),
    }

    def outcome(probe) -> str:
        try:
            return str(probe())
        except (ValueError, LookupError) as e:
            return f"{type(e).__name__}: {e}"

    return spark.createDataFrame([(k, outcome(p)) for k, p in probes.items()], "what string, outcome string")


_CHECKED = [("env", "ok", None), ("net", "failed", "no route"), ("model", "skipped", "net is failed"), ("disk", "ok", None)]


def _checks():
    def fails():
        raise ValueError("no route")

    return report.run_checks([("env", report.environment, None), ("net", fails, "env"), ("model", dict, "net"), ("disk", lambda: report.subprocess_check(["true"]), "env")])


@query(" UNION ALL ".join(f"SELECT {k} AS pos, '{n}' AS name, '{s}' AS status, {repr(e) if e else 'CAST(NULL AS VARCHAR)'} AS error, false AS all_ok, 1 AS exit_status" for k, (n, s, e) in enumerate(_CHECKED)))
def gated_checks(spark, d):
    got = _checks()
    frame = report.checks_frame(spark, got, 1.0, 2.5)
    return frame.select(F.posexplode("results").alias("pos", "r"), "all_ok").select("pos", "r.name", "r.status", "r.error", "all_ok", F.lit(report.exit_status(got)).alias("exit_status"))


@query("""SELECT n AS bytes, n / 1e9 AS gb, 4.0::DOUBLE AS seconds, 4.0::DOUBLE / 60 AS minutes, n / 1e6 / 4.0::DOUBLE AS mb_per_s FROM (SELECT CAST(sum(strlen(text)) + count(*) AS BIGINT) AS n FROM documents)""")
def transfer_metrics(spark, d):
    """Size and speed of what was written: texts, one a line."""
    path = files.scratch(spark)
    table(spark, d, "documents").select("text").write.text(path)
    size = files.read_binary(spark, path, "*.txt").agg(F.sum("length")).first()[0]
    if metrics.folder_bytes(spark, path) < size:
        raise AssertionError("folder is smaller than its files")
    return spark.createDataFrame([metrics.transfer_metrics(size, 4.0)], "bytes bigint, gb double, seconds double, minutes double, mb_per_s double")


@query("SELECT 'run.tar' AS remote_listing, 'sub/2024' AS remote_subpath, CAST(count(*) AS BIGINT) AS files, true AS present FROM region")
def upload_receipt(spark, d):
    """A folder is packed, put into another one, and its receipt read again."""
    base = files.scratch(spark)
    table(spark, d, "region").select("r_name", F.col("r_regionkey").alias("k")).repartition("k").write.partitionBy("k").text(base + "/out")
    receipt.send(spark, base + "/out", base + "/run.tar", base + "/share", "sub/2024", base + "/receipt.json")
    got = files.read_json(spark, base + "/receipt.json", schemas.RECEIPT)
    n = files.read_binary(spark, base + "/out", "*.txt").select(F.lit(1).alias("one")).agg(F.count("one").alias("files"))
    return got.where("tar_bytes > 0").select("remote_listing", "remote_subpath", "present").join(n)


_JOB_LINES = "(SELECT user_id, event_id, ts, event_id % 3 AS k, (CASE event_id % 3 WHEN 0 THEN '000' WHEN 1 THEN '001' ELSE '005' END) || ' (' || user_id::VARCHAR || '.0.0) ' || strftime(ts, '%Y-%m-%d %H:%M:%S') || ' Job event.' AS line FROM events)"
_JOB_TEXT = f"(SELECT user_id::VARCHAR AS path, string_agg(line, chr(10) ORDER BY event_id, line) || chr(10) || chr(9) || '(1) Normal termination (return value 0)' || chr(10) AS text FROM {_JOB_LINES} GROUP BY user_id)"
_JOB_EVENT = r"^([0-9]{3})\s+\(([0-9]+\.[0-9]+\.[0-9]+)\)\s+([0-9]{4}-[0-9]{2}-[0-9]{2} [0-9]{2}:[0-9]{2}:[0-9]{2})\s+(.+)$"
_JOB_FIRST = f"list_filter(events, lambda e: regexp_extract(e, '{_JOB_EVENT}', 1) = 'CODE')[1]"
_JOB_AT = f"CAST(regexp_extract({_JOB_FIRST}, '{_JOB_EVENT}', 3) AS TIMESTAMP)"


@query(f"""SELECT path, n_events, submitted, started, ended, CAST(date_diff('second', submitted, started) AS DOUBLE) AS wait_s, CAST(date_diff('second', started, ended) AS DOUBLE) AS run_s,
             CAST(nullif(regexp_extract(text, '\\(return value ([0-9]+)\\)', 1), '') AS INTEGER) AS exit_code, CAST(NULL AS VARCHAR) AS hold_reason,
             array_to_string(lines[greatest(len(lines) - 29, 1):], chr(10)) AS tail, right(text, 2000) AS tail_chars
           FROM (SELECT path, text, lines, CAST(len(events) AS INTEGER) AS n_events, {_JOB_AT.replace('CODE', '000')} AS submitted, {_JOB_AT.replace('CODE', '001')} AS started, {_JOB_AT.replace('CODE', '005')} AS ended
           FROM (SELECT *, list_filter(lines, lambda x: regexp_matches(x, '{_JOB_EVENT}')) AS events FROM (SELECT path, text, string_split(regexp_replace(text, '\\n$', ''), chr(10)) AS lines FROM {_JOB_TEXT})))""")
def log_parse(spark, d):
    """Job logs made of events, one for each user."""
    code = F.when(F.col("k") == 0, "000").when(F.col("k") == 1, "001").otherwise("005")
    rows = table(spark, d, "events").select("user_id", "event_id", "ts", F.pmod("event_id", F.lit(3)).alias("k"))
    line = F.concat(code, F.lit(" ("), F.col("user_id").cast("string"), F.lit(".0.0) "), F.date_format("ts", "yyyy-MM-dd HH:mm:ss"), F.lit(" Job event."))
    logs = rows.groupBy(F.col("user_id").cast("string").alias("path")).agg(L.ordered_join(line, F.col("event_id"), "\n").alias("text"))
    return report.job_summary(logs.withColumn("text", F.concat("text", F.lit("\n\t(1) Normal termination (return value 0)\n"))))


@query("""SELECT 'Job' || chr(10) || '  waited 218.0 s, ran 600.0 s, exit code 3' || chr(10) || '  held: disk full' || chr(10) || 'Checks' || chr(10) || '  PASS env 0.2 s' || chr(10) || '  FAIL net 1.0 s: no route'
          || chr(10) || 'Upload' || chr(10) || '  ' || printf('%.3f', n * 1e6 / 1e9) || ' GB to sub' AS report FROM (SELECT count(*) AS n FROM region)""")
def run_report(spark, d):
    """One text from a job log, a check run and an upload receipt."""
    log = "000 (1.0.0) 2024-05-01 10:00:00 Job submitted\n001 (1.0.0) 2024-05-01 10:03:38 Job executing\n012 (1.0.0) 2024-05-01 10:04:00 Job was held.\n\tdisk full\n005 (1.0.0) 2024-05-01 10:13:38 Job terminated.\n\t(1) Normal termination (return value 3)\n"
    summary = report.job_summary(spark.createDataFrame([("a", log)], "path string, text string"))
    results = [{"name": n, "status": s, "duration_sec": t, "error": e, "detail": {}, "traceback": None} for n, s, t, e in (("env", "ok", 0.2, None), ("net", "failed", 1.0, "no route"))]
    checks = report.checks_frame(spark, results, 0.0, 1.2).withColumn("present", F.lit(True))
    upload = table(spark, d, "region").agg((F.count("*") * 1_000_000).alias("tar_bytes")).select("tar_bytes", F.lit("sub").alias("remote_subpath"), F.lit(True).alias("present"))
    return report.report(summary, checks, upload)


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, '/run7' AS base FROM lineitem UNION ALL SELECT -1, 0, 0, 0, 'none'")
def literal_and_union(spark, d):
    """Frames one after the other, with a column that one of them lacks."""
    rows = table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").withColumn("base", F.lit("/run7"))
    one = rows.limit(1).select(F.lit(-1).cast(rows.schema["l_orderkey"].dataType).alias("l_orderkey"), *[F.lit(0).cast(rows.schema[c].dataType).alias(c) for c in ("l_linenumber", "l_partkey", "l_suppkey")])
    return worklist.union_all([rows, one], "place").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.coalesce("base", F.lit("none")).alias("base"))


@query("SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'exists' ELSE 'missing' END AS download FROM documents")
def present_files(spark, d):
    """Which wanted files are there with bytes in them."""
    wanted = table(spark, d, "documents").select("doc_id")
    have = wanted.where(F.pmod("doc_id", F.lit(3)) != 1).withColumn("length", F.when(F.pmod("doc_id", F.lit(3)) == 0, 5).otherwise(0))
    return files.download_states(wanted, have, "doc_id")


@query("SELECT vec_id, string_agg('v_' || vec_id::VARCHAR || '_segment_' || i::VARCHAR || '.png', ';' ORDER BY i) AS names, printf('%.3f', vec_id / 1000.0 % 1) AS score FROM (SELECT vec_id, unnest(range(3)) AS i FROM embeddings) GROUP BY vec_id")
def segment_names(spark, d):
    stem = F.concat(F.lit("v_"), F.col("vec_id").cast("string"))
    names = F.array_join(F.transform(F.sequence(F.lit(0), F.lit(2)), lambda i: L.artefact_name(stem, "segment", i)), ";")
    return table(spark, d, "embeddings").select("vec_id", names.alias("names"), L.score_text(F.pmod(F.col("vec_id") / 1000.0, F.lit(1)), 3).alias("score"))


@query("SELECT 1 AS version, count(*) AS n, count(*) * 3 AS total FROM region")
def replaced_table(spark, d):
    """A table overwritten from itself, after a swap that was cut off."""
    path = files.scratch(spark)
    table(spark, d, "region").select(F.lit(0).alias("version"), F.lit(3).alias("v")).write.parquet(path + ".old")
    writeback.recover_table(spark, path)
    writeback.replace_table(spark, spark.read.parquet(path).withColumn("version", F.col("version") + 1), path)
    return spark.read.parquet(path).groupBy("version").agg(F.count("*").alias("n"), F.sum("v").alias("total"))
