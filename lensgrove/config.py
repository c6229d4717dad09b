"""Settings of a run."""

from __future__ import annotations

from dataclasses import dataclass

DONE_STATUSES = ("ok", "dl_failed", "seg_failed")


@dataclass(frozen=True)
class RunConfig:
    """One run's settings; variants() has the four published combinations."""

    batch_size: int = 10_000
    score_threshold: float = 0.85
    mask_threshold: float = 0.8
    min_score: float | None = None
    limit: int | None = None
    limit_scope: str = "remaining"
    shard: int = 0
    num_shards: int = 1
    prompt: str = "flower"
    workers: int = 4
    prefetch_cap: int = 128
    average_rgb: bool = True
    cutouts: bool = False
    keep_empty_masks: bool = True
    overlay_without_detection: bool = True
    naming: str = "observation"

    def __post_init__(self):
        if self.limit_scope not in ("remaining", "total"):
            raise ValueError("limit_scope is 'remaining' or 'total'")
        if self.naming not in ("observation", "photo", "plain"):
            raise ValueError("naming is 'observation', 'photo' or 'plain'")
        if self.batch_size < 1 or self.num_shards < 1:
            raise ValueError("batch_size and num_shards are at least 1")

    @property
    def prefetch(self) -> int:
        return min(2 * self.workers, self.prefetch_cap)


def variants() -> dict[str, RunConfig]:
    """Named settings: fed by pages, sharded, fed by the index, and index-fed with cut-outs."""
    return {
        "paged": RunConfig(prompt="open flower", workers=1),
        "sharded": RunConfig(num_shards=5),
        "indexed": RunConfig(limit_scope="total", workers=2, prefetch_cap=64, naming="photo"),
        "cutouts": RunConfig(batch_size=1000, min_score=0.9, limit_scope="total", prefetch_cap=64, average_rgb=False, cutouts=True, keep_empty_masks=False, overlay_without_detection=False, naming="plain"),
    }
