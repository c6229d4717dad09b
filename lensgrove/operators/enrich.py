"""Enrichment of work-lists: fetch bytes, segment, reduce masks to figures, write artefacts."""

from __future__ import annotations

import io
import os
import time
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lensgrove import schemas
from lensgrove.config import RunConfig
from lensgrove.functions import artefact_name, drop_empty, top_scores
from lensgrove.sources import png
from lensgrove.sources.files import local

from .masks import ColourSegmenter, Segmenter, average_rgb, binary, bounding_box, by_confidence, cutout, overlay, resized


#: Bytes of images, or of masks and overlays, that a task gathers before it hands them on.
SLICE_BYTES = 32 << 20
#: Artefacts that a task writes together.
SLICE_FILES = 256


def write_atomic(path: str, data: bytes) -> None:
    """Write a file so that it is there whole or not at all; a repeated task writes the same bytes again."""
    write_all([(path, data)])


def write_all(files: Sequence[tuple[str, bytes]]) -> None:
    """write_atomic() of some files, all of which are open at once: they are all written before the first is synced, so
    that the file system commits them together."""
    folders, opened = set(), []
    try:
        for path, data in files:
            path = local(path)
            if (folder := os.path.dirname(path) or ".") not in folders:
                os.makedirs(folder, exist_ok=True)
                folders.add(folder)
            f = open(temp := f"{path}.{uuid.uuid4().hex}.part", "wb", buffering=0)
            opened.append((f, temp, path))
            left = memoryview(data)
            while left:
                left = left[f.write(left) :]
        for f, temp, path in opened:
            os.fsync(f.fileno())
            f.close()
            os.replace(temp, path)
    finally:
        for f, _, _ in opened:
            f.close()


def prefetched(keys: list, job: Callable, workers: int, most: int) -> Iterator[tuple[object, object, str | None]]:
    """(key, result, error) as jobs finish; at most ``most`` are under way, one is submitted for each that is taken."""
    todo = iter(keys)
    with ThreadPoolExecutor(max(1, workers)) as pool:
        running = {}

        def submit() -> None:
            for k in todo:
                running[pool.submit(job, k)] = k
                return

        for _ in range(max(1, most)):
            submit()
        while running:
            for f in wait(running, return_when=FIRST_COMPLETED)[0]:
                k = running.pop(f)
                submit()
                try:
                    yield k, f.result(), None
                except Exception as e:  # a failed download is a row, not the end of the job
                    yield k, None, f"{type(e).__name__}: {e}".strip()


def fetch(work: DataFrame, get: Callable[[str], bytes], config: RunConfig = RunConfig(), url: str = "photo_url", keep: bool = True) -> DataFrame:
    """work with content, download ('exists', 'downloaded' or 'dl_failed') and download_error.

    A file that is at image_path with bytes in it is read instead of fetched; what is fetched is written there, whole
    or not at all, unless ``keep`` is false or the row has no image_path, so that a second run finds it. Each task
    fetches with a bounded thread pool, and hands rows on as soon as they hold SLICE_BYTES.
    """
    schema = T.StructType([*work.schema.fields, T.StructField("content", T.BinaryType()), T.StructField("download", T.StringType()), T.StructField("download_error", T.StringType())])
    has_path, workers, most = "image_path" in work.columns, config.workers, config.prefetch

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:

            def job(k: int):
                path = b["image_path"].iat[k] if has_path else None
                path = local(path) if path else None
                if path and os.path.exists(path) and os.path.getsize(path):
                    with open(path, "rb") as f:
                        return f.read(), "exists"
                data = get(b[url].iat[k])
                if path and keep and data:
                    write_atomic(path, data)
                return data, "downloaded"

            rows, held = [], 0
            for k, got, why in prefetched(list(range(len(b))), job, workers, most):
                rows.append((k, None, "dl_failed", why) if why is not None else (k, *got, None))
                held += len(rows[-1][1] or b"")
                if held >= SLICE_BYTES:
                    yield _handed(b, rows)
                    rows, held = [], 0
            if rows:
                yield _handed(b, rows)

    return work.mapInPandas(run, schema)


def _handed(b: pd.DataFrame, rows: list[tuple]) -> pd.DataFrame:
    at, content, state, error = zip(*rows)
    return b.iloc[list(at)].reset_index(drop=True).assign(content=pd.Series(content, dtype=object), download=pd.Series(state, dtype=object), download_error=pd.Series(error, dtype=object))


def with_images(work: DataFrame, base: str, path: str = "image_path") -> DataFrame:
    """work with ``content`` as Spark's own image struct: every file under ``base`` is decoded in the JVM (JPEG, PNG,
    GIF, BMP) and joined by its path; a file that is missing or no image gives null."""
    spark = work.sparkSession
    plain = lambda c: F.regexp_replace(c, "^file:/+", "/")
    found = spark.read.format("image").option("dropInvalid", "true").option("recursiveFileLookup", "true").load(base)
    found = found.select(plain(F.col("image.origin")).alias("__path"), F.col("image").alias("content"))
    return work.drop("content").join(found, plain(F.col(path)) == F.col("__path"), "left").drop("__path")


def pixels(content) -> np.ndarray:
    """(h, w, 3) from PNG bytes, or from an image struct, whose channels are blue, green, red."""
    if isinstance(content, (bytes, bytearray)):
        return png.to_rgb(png.decode(bytes(content)))
    get = content.get if isinstance(content, dict) else lambda n: content[n]
    a = np.frombuffer(get("data"), np.uint8).reshape(get("height"), get("width"), get("nChannels"))
    return np.repeat(a, 3, 2) if a.shape[2] == 1 else np.ascontiguousarray(a[:, :, 2::-1])


ENRICHED = T.StructType(
    [
        T.StructField("instances", T.ArrayType(schemas.INSTANCE)),
        T.StructField("overlay", T.BinaryType()),
        T.StructField("cutouts", T.ArrayType(T.BinaryType())),
        T.StructField("overlay_count", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("error", T.StringType()),
        T.StructField("duration_sec", T.DoubleType()),
    ]
)


def enrich_image(content, segmenter: Segmenter, config: RunConfig) -> dict:
    """One image's instances in order of confidence, with overlay and cut-outs; never raises."""
    began = time.perf_counter()
    out: dict = {"instances": [], "overlay": None, "cutouts": [], "overlay_count": 0, "status": "ok", "error": None}
    try:
        if content is None:
            return out | {"status": "dl_failed", "duration_sec": 0.0}
        rgb = pixels(content)
        h, w = rgb.shape[:2]
        floor = config.score_threshold if config.min_score is None else config.min_score
        kept = []
        for mask, score in by_confidence([x for x in segmenter.segment(rgb, config.prompt) if x[1] >= floor]):
            m = resized(binary(mask), h, w)
            if not m.any() and not config.keep_empty_masks:
                continue
            kept.append(m)
            out["instances"].append(
                {"score": float(score), "n_pixels": int(m.sum()), "avg_rgb": average_rgb(rgb, m) if config.average_rgb else None, "bbox": bounding_box(m), "mask": {"h": h, "w": w, "data": m.tobytes()}}
            )
        if kept or config.overlay_without_detection:
            out["overlay"], out["overlay_count"] = overlay(rgb, kept, [f"{config.prompt} {x['score']:.3f}" for x in out["instances"]])
        if config.cutouts:
            out["cutouts"] = [cutout(rgb, m) for m in kept]
    except Exception as e:
        out = {"instances": [], "overlay": None, "cutouts": [], "overlay_count": 0, "status": "seg_failed", "error": f"{type(e).__name__}: {e}"}
    return out | {"duration_sec": round(time.perf_counter() - began, 3)}


def segment(images: DataFrame, segmenter: Segmenter | None = None, config: RunConfig = RunConfig(), content: str = "content") -> DataFrame:
    """images without their bytes, with ENRICHED columns; ``content`` is PNG bytes or an image struct of with_images(). The model goes to each worker once a task.

    Materialise the result before several consumers read it, or the model runs for each of them.
    """
    model = segmenter or ColourSegmenter()
    keep = [f for f in images.schema.fields if f.name != content]
    schema = T.StructType([*keep, *ENRICHED.fields])

    def handed(rest: pd.DataFrame, found: list[dict]) -> pd.DataFrame:
        for f in ENRICHED.fields:
            rest[f.name] = pd.Series([x[f.name] for x in found], dtype="float64" if f.name == "duration_sec" else object)
        rest["overlay_count"] = rest["overlay_count"].astype("int32")
        return rest

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rest, begin, found, held = b.drop(columns=[content]), 0, [], 0
            for k, c in enumerate(b[content]):
                x = enrich_image(c, model, config)
                found.append(x)
                held += len(x["overlay"] or b"") + sum(map(len, filter(None, x["cutouts"]))) + sum(len(i["mask"]["data"]) for i in x["instances"])
                if held >= SLICE_BYTES or k + 1 == len(b):
                    yield handed(rest.iloc[begin : k + 1].reset_index(drop=True), found)
                    begin, found, held = k + 1, [], 0

    return images.mapInPandas(run, schema)


def ledger_rows(enriched: DataFrame, config: RunConfig = RunConfig()) -> DataFrame:
    """Ledger columns of enriched images: counts, file names, scores and colours, in order of confidence."""
    found = F.col("instances")
    if config.min_score is not None:
        found = top_scores(found, config.min_score)
    if not config.keep_empty_masks:
        found = drop_empty(found)
    stem = F.col("stem")
    files = F.transform(F.sequence(F.lit(0), F.size("found") - 1), lambda i: F.concat_ws("/", "mask_batch_relpath", artefact_name(stem, "instance", i)))
    return enriched.withColumn("found", found).withColumns(
        {
            "num_instances": F.size("found"),
            "mask_files": F.when(F.size("found") > 0, files).otherwise(F.array().cast("array<string>")),
            "mask_scores": F.transform("found", lambda x: x["score"]),
            "avg_rgb": F.filter(F.transform("found", lambda x: x["avg_rgb"]), lambda c: c.isNotNull()),
            "shard": F.lit(config.shard),
        }
    ).drop("found", "instances", "overlay", "cutouts", "overlay_count")


def npy(mask: np.ndarray) -> bytes:
    """A mask as the bytes of an .npy file."""
    out = io.BytesIO()
    np.save(out, mask)
    return out.getvalue()


def write_artefacts(enriched: DataFrame, base: str) -> DataFrame:
    """Write masks, overlays and cut-outs under ``base``; gives (global_index, files, bytes) for each image.

    Lazy: it writes when the result is used. Names depend on the row alone and files appear whole, so repeated
    tasks do no harm. ``base`` is a folder that all executors share.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows, todo, held = [], [], 0
            for r in b.itertuples(index=False):
                files = []
                for i, x in enumerate(r.instances):
                    m = np.frombuffer(x["mask"]["data"], np.uint8).reshape(x["mask"]["h"], x["mask"]["w"])
                    files.append((f"masks/{r.batch_name}/{r.stem}_instance_{i}.npy", npy(m)))
                files += [(f"segments/{r.batch_name}/{r.stem}_segment_{i}.png", c) for i, c in enumerate(r.cutouts) if c is not None]
                if r.overlay is not None:
                    files.append((f"overlays/{r.batch_name}/{r.stem}_overlay.png", r.overlay))
                rows.append((r.global_index, len(files), sum(len(d) for _, d in files)))
                for name, data in files:
                    todo.append((os.path.join(base, name), data))
                    held += len(data)
                    if len(todo) >= SLICE_FILES or held >= SLICE_BYTES:
                        write_all(todo)
                        todo, held = [], 0
            write_all(todo)
            yield pd.DataFrame(rows, columns=["global_index", "files", "bytes"])

    return enriched.select("global_index", "batch_name", "stem", "instances", "overlay", "cutouts").mapInPandas(run, "global_index bigint, files int, bytes bigint")
