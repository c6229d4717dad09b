"""Registered queries of the engine's own operators over the star and event tables, and their DuckDB SQL.

Photos are line items, observations are orders, taxa are customers; scores are elements of embeddings, the ledger
of finished work is the labels table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lensgrove import functions as L
from lensgrove.operators import catalog, metrics, report, worklist, writeback

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
PIXEL_ROW = 8
THRESHOLD = 0.2
#: Identifies a line item together with its order.
LINE_ORDER = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice")


def query(sql: str | None = None):
    """Register a function, and its SQL if it has one, under its name."""

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def raw_star(spark: SparkSession, d: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Photos, observations and taxa as dumps have them: texts only."""
    photos = table(spark, d, "lineitem").select(
        F.concat(F.col("l_orderkey").cast("string"), F.lit("0"), F.col("l_linenumber").cast("string")).alias("photo_id"),
        F.col("l_orderkey").cast("string").alias("observation_uuid"),
        F.when(F.col("l_returnflag") == "A", "jpg").when(F.col("l_returnflag") == "N", "jpeg").otherwise("png").alias("extension"),
    )
    observations = table(spark, d, "orders").select(
        F.col("o_orderkey").cast("string").alias("observation_uuid"),
        F.when(F.pmod("o_orderkey", F.lit(50)) == 0, "n/a").otherwise(F.col("o_custkey").cast("string")).alias("taxon_id"),
        F.when(F.col("o_orderstatus") == "F", "research").when(F.col("o_orderstatus") == "O", "casual").otherwise("needs_id").alias("quality_grade"),
        F.concat(F.pmod("o_custkey", F.lit(90)).cast("string"), F.lit(".5")).alias("latitude"),
        F.when(F.pmod("o_orderkey", F.lit(7)) == 0, "").otherwise(F.concat(F.lit("-"), F.pmod("o_orderkey", F.lit(180)).cast("string"), F.lit(".25"))).alias("longitude"),
    )
    taxa = table(spark, d, "customer").where(F.pmod("c_custkey", F.lit(11)) != 0).select(F.col("c_custkey").cast("string").alias("taxon_id"), F.col("c_name").alias("name"))
    return photos, observations, taxa


_STAR = """
WITH photos AS (SELECT l_orderkey::VARCHAR || '0' || l_linenumber::VARCHAR AS photo_id, l_orderkey::VARCHAR AS observation_uuid,
                       CASE l_returnflag WHEN 'A' THEN 'jpg' WHEN 'N' THEN 'jpeg' ELSE 'png' END AS extension FROM lineitem),
obs AS (SELECT o_orderkey::VARCHAR AS observation_uuid, CASE WHEN o_orderkey % 50 = 0 THEN 'n/a' ELSE o_custkey::VARCHAR END AS taxon_id,
               CASE o_orderstatus WHEN 'F' THEN 'research' WHEN 'O' THEN 'casual' ELSE 'needs_id' END AS quality_grade,
               (o_custkey % 90)::VARCHAR || '.5' AS latitude,
               CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE '-' || (o_orderkey % 180)::VARCHAR || '.25' END AS longitude FROM orders),
taxa AS (SELECT c_custkey::VARCHAR AS taxon_id, c_name AS name FROM customer WHERE c_custkey % 11 <> 0),
wanted AS (SELECT obs.*, taxa.name AS taxon_name FROM obs LEFT JOIN taxa USING (taxon_id) WHERE quality_grade = 'research'),
idx AS (SELECT extension, taxon_name, quality_grade, TRY_CAST(longitude AS FLOAT) AS longitude, TRY_CAST(latitude AS FLOAT) AS latitude,
               TRY_CAST(photo_id AS BIGINT) AS photo_id, TRY_CAST(taxon_id AS INTEGER) AS taxon_id
        FROM photos JOIN wanted USING (observation_uuid))
"""


@query(_STAR + "SELECT * FROM idx")
def catalog_index_build(spark, d):
    return catalog.build_index(*raw_star(spark, d))


@query(_STAR + "SELECT count(*) AS n FROM idx")
def catalog_row_count(spark, d):
    return catalog.build_index(*raw_star(spark, d)).agg(F.count(F.lit(1)).alias("n"))


@query(_STAR + "SELECT photo_id, extension, taxon_name, latitude FROM idx WHERE taxon_id = 37")
def catalog_point_lookup(spark, d):
    return catalog.look_up(catalog.build_index(*raw_star(spark, d)), 37, "photo_id", "extension", "taxon_name", "latitude")


@query(_STAR + "SELECT count(*) AS n_photos, count(taxon_name) AS n_named, count(longitude) AS n_placed FROM idx")
def catalog_non_null_counts(spark, d):
    index = catalog.build_index(*raw_star(spark, d))
    return index.agg(F.count(F.lit(1)).alias("n_photos"), F.count("taxon_name").alias("n_named"), F.count("longitude").alias("n_placed"))


_NUMBER_TEXT = """CASE event_id % 6 WHEN 0 THEN event_id::VARCHAR WHEN 1 THEN event_id::VARCHAR || '.5' WHEN 2 THEN '-' || event_id::VARCHAR || '.25'
                  WHEN 3 THEN (event_id % 9)::VARCHAR || 'e3' WHEN 4 THEN '' ELSE 'x' || event_id::VARCHAR END"""


@query(f"""SELECT event_id, TRY_CAST(t AS INTEGER) AS as_int, TRY_CAST(t AS BIGINT) AS as_long, TRY_CAST(t AS FLOAT) AS as_float
           FROM (SELECT event_id, {_NUMBER_TEXT} AS t FROM events)""")
def try_cast_columns(spark, d):
    e, m = F.col("event_id").cast("string"), F.pmod("event_id", F.lit(6))
    t = F.when(m == 0, e).when(m == 1, F.concat(e, F.lit(".5"))).when(m == 2, F.concat(F.lit("-"), e, F.lit(".25")))
    t = t.when(m == 3, F.concat(F.pmod("event_id", F.lit(9)).cast("string"), F.lit("e3"))).when(m == 4, "").otherwise(F.concat(F.lit("x"), e))
    rows = table(spark, d, "events").select("event_id", t.alias("t"))
    return rows.select("event_id", L.lenient_int(F.col("t")).alias("as_int"), L.lenient_int(F.col("t"), "bigint").alias("as_long"), L.lenient_float(F.col("t")).alias("as_float"))


@query("SELECT page_id, url FROM pages WHERE url IS NOT NULL AND length(url) > 0 AND html IS NOT NULL AND length(html) > 0")
def nonempty_filter(spark, d):
    return table(spark, d, "pages").where(worklist.filled("url", "html")).select("page_id", "url")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
          row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS image_index FROM lineitem""")
def image_ordinal(spark, d):
    rows = worklist.image_ordinal(table(spark, d, "lineitem"), "l_orderkey", LINE_ORDER[1:])
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "image_index")


_GLOBAL = "row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice)"
_NUMBERED = f"SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, {_GLOBAL} AS global_index FROM lineitem"


def _numbered(spark, d):
    rows = table(spark, d, "lineitem").select(*LINE_ORDER)
    return worklist.global_index(rows, LINE_ORDER).drop("l_extendedprice")


@query(f"SELECT *, printf('batch_%05d', (global_index - 1) // 1000 + 1) AS batch_name FROM ({_NUMBERED})")
def global_index_batch(spark, d):
    return _numbered(spark, d).withColumn("batch_name", L.batch_name(F.col("global_index"), 1000))


@query(f"SELECT * FROM ({_NUMBERED}) WHERE global_index % 5 = 7 % 5")
def shard_select(spark, d):
    return worklist.shard(_numbered(spark, d), 7, 5)


@query(f"SELECT *, CAST(global_index % 5 AS INTEGER) AS shard FROM ({_NUMBERED})")
def shard_union(spark, d):
    rows = _numbered(spark, d)
    return worklist.union_all([worklist.shard(rows, k, 5) for k in range(5)], "shard")


_DONE = "(SELECT DISTINCT doc_id FROM labels WHERE quality IN (1) AND doc_id IS NOT NULL)"


def _work_and_done(spark, d):
    ledger = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "ok").otherwise("pending").alias("status"))
    return table(spark, d, "documents").select("doc_id", "lang", "source"), worklist.done_keys(ledger, "doc_id")


@query(f"SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN {_DONE}")
def todo_anti_join(spark, d):
    return worklist.remaining(*_work_and_done(spark, d), "doc_id")


@query(f"SELECT doc_id, lang, source FROM documents WHERE doc_id NOT IN {_DONE} ORDER BY doc_id LIMIT 100")
def limit_remaining(spark, d):
    return worklist.limited(*_work_and_done(spark, d), 100, "remaining", "doc_id")


@query(f"SELECT doc_id, lang, source FROM (SELECT * FROM documents ORDER BY doc_id LIMIT 100) WHERE doc_id NOT IN {_DONE}")
def limit_total(spark, d):
    return worklist.limited(*_work_and_done(spark, d), 100, "total", "doc_id")


@query("SELECT d.doc_id, d.lang, l.toxic FROM documents d LEFT JOIN (SELECT doc_id, toxic FROM labels WHERE quality = 1) l ON d.doc_id = l.doc_id")
def writeback_left_join(spark, d):
    ledger = table(spark, d, "labels").select("doc_id", "toxic", F.when(F.col("quality") == 1, "ok").otherwise("seg_failed").alias("status"))
    docs = table(spark, d, "documents").select("doc_id", "lang", F.lit("old").alias("toxic"))
    return writeback.write_back(docs, ledger, "toxic", ("doc_id",))


@query("SELECT event_type AS status, count(*) AS n FROM events GROUP BY event_type")
def status_counters(spark, d):
    return metrics.status_counters(table(spark, d, "events"), "event_type")


@query("""SELECT page, n_keys, n_rows, CAST(sum(n_keys) OVER (ORDER BY page) AS BIGINT) AS keys_so_far, CAST(sum(n_rows) OVER (ORDER BY page) AS BIGINT) AS rows_so_far
          FROM (SELECT event_id // 200 AS page, count(DISTINCT user_id) AS n_keys, count(*) AS n_rows FROM events GROUP BY 1)""")
def page_running_totals(spark, d):
    rows = table(spark, d, "events").select(F.expr("event_id div 200").alias("page"), F.col("user_id").alias("id"))
    return metrics.page_totals(rows)


@query("SELECT event_id // 200 AS page, max_by(user_id, event_id) AS last_key FROM events WHERE user_id IS NOT NULL GROUP BY 1")
def last_key_of_page(spark, d):
    rows = table(spark, d, "events").select(F.expr("event_id div 200").alias("page"), "event_id", "user_id")
    return metrics.last_key(rows, "page", "event_id", "user_id")


@query("""SELECT c.doc_id AS conv_id, CASE WHEN t.conv_id IS NULL THEN NULL ELSE t.pos END AS photo_pos, t.role
          FROM (SELECT doc_id FROM labels) c LEFT JOIN
          (SELECT conv_id, role, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1 AS INTEGER) AS pos FROM conversations) t ON t.conv_id = c.doc_id""")
def nested_explode_outer(spark, d):
    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("photos"))
    ids = table(spark, d, "labels").select(F.col("doc_id").alias("conv_id"))
    return worklist.explode_photos(ids.join(turns, "conv_id", "left")).select("conv_id", "photo_pos", F.col("photo.role").alias("role"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, json_extract_string(props, '$.missing') AS missing FROM events")
def json_field_access(spark, d):
    parsed = F.from_json("props", "k BIGINT, missing STRING")
    return table(spark, d, "events").select("event_id", parsed.alias("p")).select("event_id", "p.k", "p.missing")


@query("""SELECT doc_id, '{"doc_id":' || doc_id::VARCHAR || ',"lang":"' || lang || '"}' AS json FROM documents""")
def json_serialise(spark, d):
    return table(spark, d, "documents").select("doc_id", F.to_json(F.struct("doc_id", "lang")).alias("json"))


_PHOTO_URLS = """(SELECT page_id, url || CASE page_id % 5 WHEN 0 THEN '/square.JPG?x=1' WHEN 1 THEN '/medium.jpeg' WHEN 2 THEN '/a.gif#f' WHEN 3 THEN '/thumb/large.png' ELSE '' END AS url,
                    CASE WHEN page_id % 3 = 0 THEN CASE page_id % 5 WHEN 2 THEN 'gif' ELSE 'jpg' END END AS ext,
                    CASE WHEN page_id % 4 = 0 THEN 'http://o/' || page_id::VARCHAR ELSE '' END AS original
                  FROM (SELECT page_id, regexp_replace(url, '[?#].*$', '') AS url FROM pages))"""
_PATH_EXT = r"lower(regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^([A-Za-z][A-Za-z0-9+.-]*:)?//[^/]*', ''), '\.([^./]*)$', 1))"


def _photo_urls(spark, d):
    m = F.pmod("page_id", F.lit(5))
    tail = F.when(m == 0, "/square.JPG?x=1").when(m == 1, "/medium.jpeg").when(m == 2, "/a.gif#f").when(m == 3, "/thumb/large.png").otherwise("")
    ext = F.when(F.pmod("page_id", F.lit(3)) == 0, F.when(m == 2, "gif").otherwise("jpg"))
    original = F.when(F.pmod("page_id", F.lit(4)) == 0, F.concat(F.lit("http://o/"), F.col("page_id").cast("string"))).otherwise("")
    return table(spark, d, "pages").select("page_id", F.concat(F.regexp_replace("url", r"[?#].*$", ""), tail).alias("url"), ext.alias("ext"), original.alias("original"))


@query(f"SELECT page_id, CASE WHEN e IN ('jpg', 'jpeg', 'png', 'gif') THEN e END AS ext FROM (SELECT page_id, {_PATH_EXT} AS e FROM {_PHOTO_URLS})")
def url_ext(spark, d):
    return _photo_urls(spark, d).select("page_id", L.url_ext(F.col("url")).alias("ext"))


@query(rf"""SELECT page_id, CASE WHEN e IN ('jpg', 'jpeg', 'png') THEN e ELSE 'jpg' END AS ext, CASE WHEN lower(x) IN ('jpg', 'jpeg', 'png') THEN lower(x) ELSE 'jpg' END AS from_value
            FROM (SELECT page_id, lower(regexp_extract(string_split(url, '?')[1], '[^/]\.([^./]*)$', 1)) AS e, ext AS x FROM {_PHOTO_URLS})""")
def storage_ext(spark, d):
    return _photo_urls(spark, d).select("page_id", L.storage_ext(F.col("url")).alias("ext"), L.value_ext(F.concat(F.lit(".."), F.col("ext"))).alias("from_value"))


_SIZED = "nullif(url, '')"
for _size in ("original", "large", "medium", "small", "square"):
    _SIZED = f"CASE WHEN contains(url, '/{_size}.') THEN replace(url, '/{_size}.', '/original.') ELSE {_SIZED} END"


@query(f"""SELECT page_id, coalesce(CASE WHEN page_id <> 0 AND length(ext) > 0 THEN 'https://photos.example.org/photos/' || page_id::VARCHAR || '/original.' || ext END,
           nullif(original, ''), {_SIZED}) AS best FROM {_PHOTO_URLS}""")
def best_url(spark, d):
    return _photo_urls(spark, d).select("page_id", L.best_url(F.col("page_id"), F.col("ext"), F.col("original"), F.col("url")).alias("best"))


def _sanitized(x: str) -> str:
    return rf"regexp_replace(regexp_replace(regexp_replace(coalesce({x}, ''), '^[ \t\n\r]+|[ \t\n\r]+$', '', 'g'), '[ \t\n\r]+', '_', 'g'), '[^A-Za-z0-9_]', '', 'g')"


@query(f"SELECT doc_id, {_sanitized('text')} AS token FROM documents")
def sanitize_token(spark, d):
    return table(spark, d, "documents").select("doc_id", L.sanitize(F.col("text")).alias("token"))


_BINOMIAL = f"""CASE WHEN n IS NULL OR trim(n) = '' THEN 'Unknown_unknown'
   WHEN len(string_split(trim(n), ' ')) >= 2 THEN {_sanitized("upper(string_split(trim(n), ' ')[1][1]) || lower(string_split(trim(n), ' ')[1][2:])")} || '_' || {_sanitized("lower(string_split(trim(n), ' ')[2])")}
   ELSE {_sanitized('trim(n)')} END"""


@query(f"SELECT p_partkey, {_BINOMIAL} AS species FROM (SELECT p_partkey, CASE p_partkey % 7 WHEN 0 THEN ' ' WHEN 1 THEN upper(p_name) WHEN 2 THEN string_split(p_name, ' ')[1] ELSE p_name END AS n FROM part)")
def genus_species(spark, d):
    m = F.pmod("p_partkey", F.lit(7))
    n = F.when(m == 0, " ").when(m == 1, F.upper("p_name")).when(m == 2, F.split("p_name", " ")[0]).otherwise(F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", L.binomial(n).alias("species"))


@query(f"""WITH n AS ({_NUMBERED}), w AS (SELECT n.*, p.p_name AS n FROM n JOIN part p ON p.p_partkey = n.l_partkey),
           s AS (SELECT *, {_BINOMIAL} || '_' || l_orderkey::VARCHAR || '_image' || l_linenumber::VARCHAR AS stem, printf('batch_%05d', (global_index - 1) // 1000 + 1) AS b FROM w)
           SELECT global_index, stem || '.jpg' AS image_name, 'images/' || b || '/' || stem || '.jpg' AS image_relpath, 'overlays/' || b || '/' || stem || '_overlay.png' AS overlay_relpath,
           '/base/masks/' || b AS mask_dir FROM s""")
def file_name_paths(spark, d):
    from lensgrove.config import RunConfig

    named = _numbered(spark, d).join(table(spark, d, "part").select("p_partkey", "p_name"), F.col("l_partkey") == F.col("p_partkey"))
    rows = named.select("global_index", L.binomial(F.col("p_name")).alias("genus_species"), F.col("l_orderkey").alias("observation_id"), F.col("l_linenumber").alias("image_index"), F.lit("http://x/a.jpg").alias("photo_url"))
    return worklist.with_paths(rows, "/base", RunConfig(batch_size=1000)).select("global_index", "image_name", "image_relpath", "overlay_relpath", "mask_dir")


_DETECTED = f"""(SELECT vec_id, label, list_filter(list_sort(list_transform(embedding, lambda x: x::DOUBLE), 'DESC'), lambda x: x >= {THRESHOLD}) AS scores FROM embeddings)"""


def _detected(spark, d):
    found = F.transform("embedding", lambda x: F.struct(x.cast("double").alias("score")))
    kept = L.top_scores(L.sort_instances(found), THRESHOLD)
    return table(spark, d, "embeddings").select("vec_id", "label", F.transform(kept, lambda x: x["score"]).alias("scores"))


@query(f"SELECT vec_id, CAST(len(scores) AS INTEGER) AS num_masks, array_to_string(list_transform(scores, lambda x: printf('%.4f', x)), ',') AS mask_scores, scores[1] AS best FROM {_DETECTED}")
def detections_sorted_topk(spark, d):
    return _detected(spark, d).select("vec_id", F.size("scores").alias("num_masks"), L.scores_text(F.col("scores")).alias("mask_scores"), F.try_element_at("scores", F.lit(1)).alias("best"))


_PIXELS = f"(SELECT vec_id, unnest(range(0, len(embedding))) AS i, unnest(embedding)::DOUBLE AS v FROM embeddings)"


@query(f"""SELECT vec_id, CAST(min(i % {PIXEL_ROW}) AS INTEGER) AS x1, CAST(min(i // {PIXEL_ROW}) AS INTEGER) AS y1, CAST(max(i % {PIXEL_ROW}) AS INTEGER) AS x2, CAST(max(i // {PIXEL_ROW}) AS INTEGER) AS y2,
           count(*) AS n_pixels, CAST(round_even(avg((i * 37 + vec_id) % 256), 0) AS INTEGER) AS r FROM {_PIXELS} WHERE v > 0.1 GROUP BY vec_id""")
def mask_statistics(spark, d):
    pixels = table(spark, d, "embeddings").select("vec_id", F.posexplode("embedding").alias("i", "v")).where(F.col("v").cast("double") > 0.1)
    x, y = F.pmod("i", F.lit(PIXEL_ROW)), F.expr(f"cast(i div {PIXEL_ROW} as int)")
    red = F.pmod(F.col("i") * 37 + F.col("vec_id"), F.lit(256))
    return pixels.groupBy("vec_id").agg(F.min(x).alias("x1"), F.min(y).alias("y1"), F.max(x).alias("x2"), F.max(y).alias("y2"), F.count("*").alias("n_pixels"), F.bround(F.avg(red), 0).cast("int").alias("r"))


@query("""SELECT vec_id, len(list_filter(embedding, lambda x: x::DOUBLE > 0.2)) > 0 AS any_set, len(list_filter(embedding, lambda x: x::DOUBLE <= 0.3)) = len(embedding) AS all_low FROM embeddings""")
def any_and_all(spark, d):
    e = F.transform("embedding", lambda x: (x.cast("double") > 0.2).cast("int"))
    return table(spark, d, "embeddings").select("vec_id", L.any_of(e).alias("any_set"), L.all_of(F.transform("embedding", lambda x: x.cast("double") <= 0.3)).alias("all_low"))


@query("SELECT user_id, string_agg(event_type, ';' ORDER BY event_id, event_type) AS types FROM events GROUP BY user_id")
def ordered_string_join(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(L.ordered_join(F.col("event_type"), F.col("event_id"), ";").alias("types"))


@query(f"""WITH i AS (SELECT *, len(scores) AS n, list_sum(scores) / nullif(len(scores), 0) AS m FROM {_DETECTED}),
           s AS (SELECT unnest(scores) AS v FROM i), o AS (SELECT label, avg(m) AS m FROM i GROUP BY label),
           a AS (SELECT count(*)::DOUBLE AS images, count_if(n > 0)::DOUBLE AS hits, sum(n)::DOUBLE AS masks FROM i)
           SELECT metric, round(value, 6) AS value FROM (
           SELECT 'images' AS metric, images AS value FROM a UNION ALL SELECT 'with_detection', hits FROM a UNION ALL SELECT 'without_detection', images - hits FROM a
           UNION ALL SELECT 'detection_rate_pct', hits / images * 100 FROM a UNION ALL SELECT 'masks', masks FROM a UNION ALL SELECT 'masks_per_hit', masks / hits FROM a
           UNION ALL SELECT 'mean_score', avg(v) FROM s UNION ALL SELECT 'median_score', median(v) FROM s UNION ALL SELECT 'mean_score_per_image', avg(m) FROM i
           UNION ALL SELECT 'wall_s', 998.0 UNION ALL SELECT 'busy_s', 139.7 UNION ALL SELECT 'busy_pct', 139.7 / 998.0 * 100
           UNION ALL SELECT 'images_per_s', images / 998.0 FROM a UNION ALL SELECT 'images_per_busy_s', images / 139.7 FROM a UNION ALL SELECT 'mb_per_image', 2e9 / images / 1e6 FROM a
           UNION ALL SELECT 'load_s', 8.786 UNION ALL SELECT 'observations', count(*)::DOUBLE FROM o
           UNION ALL SELECT 'images_per_observation', (SELECT images FROM a) / count(*) FROM o UNION ALL SELECT 'mean_score_per_observation', avg(m) FROM o)""")
def kpi_rollup(spark, d):
    images = _detected(spark, d).withColumnRenamed("label", "observation_id")
    return metrics.kpis(images, 998.0, 139.7, 2_000_000_000, 8.786).withColumn("value", F.round("value", 6))


@query("""SELECT event_id, user_id, CASE WHEN broken THEN 'skipped' WHEN ok THEN 'ok' ELSE 'failed' END AS gated FROM (
          SELECT *, coalesce(bool_or(NOT ok) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), false) AS broken
          FROM (SELECT event_id, user_id, event_id % 17 <> 0 AS ok FROM events))""")
def step_gate(spark, d):
    steps = table(spark, d, "events").select("event_id", "user_id", (F.pmod("event_id", F.lit(17)) != 0).alias("ok"))
    return report.gate(steps, "user_id", "event_id").drop("ok")


@query("""SELECT user_id, CAST(date_diff('second', min(ts), max(ts)) AS DOUBLE) AS elapsed_s, min_by(event_type, event_id) AS first_type, bool_and(value > 0) AS all_positive
          FROM events GROUP BY user_id""")
def first_event_elapsed(spark, d):
    e = table(spark, d, "events")
    whole = lambda c: F.date_trunc("SECOND", c)
    return e.groupBy("user_id").agg(
        L.seconds_between(whole(F.min("ts")), whole(F.max("ts"))).alias("elapsed_s"), F.min_by("event_type", "event_id").alias("first_type"), F.bool_and(F.col("value") > 0).alias("all_positive")
    )


@query("SELECT user_id, event_type, min_by(ts, event_id) AS first_at FROM events GROUP BY user_id, event_type")
def first_event_per_code(spark, d):
    return metrics.first_event(table(spark, d, "events"), "user_id", "event_type", "ts", ["event_id"])


@query("""SELECT doc_id, array_to_string(lines[greatest(len(lines) - 1, 1):], chr(10)) AS tail, right(text, 50) AS tail_chars
          FROM (SELECT doc_id, text, string_split(regexp_replace(text, '\r?\n$', ''), chr(10)) AS lines FROM documents)""")
def text_tails(spark, d):
    return table(spark, d, "documents").select("doc_id", L.tail_lines(F.col("text"), 2).alias("tail"), L.tail_chars(F.col("text"), 50).alias("tail_chars"))


@query("""SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 'PASS' WHEN 1 THEN 'FAIL' WHEN 2 THEN 'SKIP' END AS mark, '(' || (doc_id % 256)::VARCHAR || ',7,9)' AS rgb,
          CASE WHEN doc_id % 2 = 0 THEN lang ELSE source END AS first, '1;2;' || doc_id::VARCHAR AS numbers FROM documents""")
def small_texts(spark, d):
    m = F.pmod("doc_id", F.lit(4))
    status = F.when(m == 0, "ok").when(m == 1, "failed").when(m == 2, "skipped").otherwise("other")
    rgb = F.struct(F.pmod("doc_id", F.lit(256)).cast("int").alias("r"), F.lit(7).alias("g"), F.lit(9).alias("b"))
    first = L.first_filled(F.when(F.pmod("doc_id", F.lit(2)) == 0, F.col("lang")).otherwise(""), F.col("source"))
    numbers = L.int_list(F.concat(F.lit("1, 2,,"), F.col("doc_id").cast("string")))
    return table(spark, d, "documents").select("doc_id", L.marker(status).alias("mark"), L.rgb_text(rgb).alias("rgb"), first.alias("first"), F.array_join(numbers.cast("array<string>"), ";").alias("numbers"))


from . import io_queries  # noqa: E402, F401  its queries are registered with these
