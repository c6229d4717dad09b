"""Images for queries and tests: each embedding as an 8 x 8 picture."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lensgrove.sources import png

#: Pictures that a task makes and works on: the work goes by rows, which hold few bytes, and a file's splits go by bytes.
PART_ROWS = 2500


def picture(values: np.ndarray) -> bytes:
    """Elements above 0.1 as red pixels, by size, on grey; 8 wide."""
    v = np.resize(np.asarray(values, np.float64), 64).reshape(8, 8)
    out = np.full((8, 8, 3), 90, np.uint8)
    out[v > 0.1] = (20, 20, 20)
    out[..., 0] = np.where(v > 0.1, np.clip(120 + v * 400, 0, 255), out[..., 0]).astype(np.uint8)
    return png.encode(out)


def pictures(embeddings: DataFrame) -> DataFrame:
    """(global_index, batch_name, stem, mask_batch_relpath, content) of every embedding."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"global_index": b["vec_id"], "content": [picture(v) for v in b["embedding"]]})

    parts = -(-embeddings.count() // PART_ROWS) or 1
    made = embeddings.select("vec_id", "embedding").repartition(parts, "vec_id").mapInPandas(run, "global_index bigint, content binary")
    batch = F.lit("batch_00001")
    return made.withColumns({"batch_name": batch, "stem": F.concat(F.lit("v_"), F.col("global_index").cast("string")), "mask_batch_relpath": F.concat_ws("/", F.lit("masks"), batch)})
