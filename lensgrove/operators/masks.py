"""Masks and images in numpy: what an enrichment task does to one image."""

from __future__ import annotations

import io
from dataclasses import dataclass
from typing import Protocol

import numpy as np

from lensgrove.sources import png

OVERLAY_ALPHA = 95
BOX_WIDTH = 4


class Segmenter(Protocol):
    """A model: masks and scores of what a prompt names in an RGB image."""

    def segment(self, rgb: np.ndarray, prompt: str) -> list[tuple[np.ndarray, float]]: ...


@dataclass(frozen=True)
class ColourSegmenter:
    """Stand-in for a model: connected regions of saturated pixels, scored by their mean saturation."""

    least_saturation: int = 64
    score_threshold: float = 0.0

    def segment(self, rgb: np.ndarray, prompt: str) -> list[tuple[np.ndarray, float]]:
        wide = rgb.astype(np.int32)
        saturation = wide.max(2) - wide.min(2)
        on = saturation >= self.least_saturation
        label = np.where(on, np.arange(1, on.size + 1).reshape(on.shape), 0)
        while True:  # each pixel takes the largest label beside it
            padded = np.pad(label, 1)
            most = np.maximum.reduce([padded[1:-1, 1:-1], padded[:-2, 1:-1], padded[2:, 1:-1], padded[1:-1, :-2], padded[1:-1, 2:]])
            new = np.where(on, most, 0)
            if (new == label).all():
                break
            label = new
        found = [((label == k).astype(np.uint8), float(saturation[label == k].mean() / 255)) for k in np.unique(label[label > 0])]
        return [(m, s) for m, s in found if s >= self.score_threshold]


def binary(mask: np.ndarray) -> np.ndarray:
    """Any mask as a 2-D array of 0 and 1."""
    return (np.squeeze(np.asarray(mask)) > 0).astype(np.uint8)


def resized(mask: np.ndarray, height: int, width: int) -> np.ndarray:
    """Nearest-neighbour resize, by pixel centres; the mask itself if it fits."""
    h, w = mask.shape
    if (h, w) == (height, width):
        return mask
    ys = np.minimum(((np.arange(height) + 0.5) * h / height).astype(int), h - 1)
    xs = np.minimum(((np.arange(width) + 0.5) * w / width).astype(int), w - 1)
    return mask[ys[:, None], xs[None, :]]


def bounding_box(mask: np.ndarray) -> dict | None:
    """Inclusive corners of what is set, or None."""
    ys, xs = np.nonzero(mask)
    if not len(ys):
        return None
    return {"x1": int(xs.min()), "y1": int(ys.min()), "x2": int(xs.max()), "y2": int(ys.max())}


def average_rgb(rgb: np.ndarray, mask: np.ndarray) -> dict | None:
    """Mean colour under a mask, rounded half to even, or None for an empty mask."""
    inside = rgb[mask > 0]
    if not len(inside):
        return None
    return dict(zip("rgb", (int(v) for v in np.rint(inside.astype(np.float64).mean(0)))))


def by_confidence(found: list[tuple[np.ndarray, float]]) -> list[tuple[np.ndarray, float]]:
    """Highest score first; ties keep their order."""
    return sorted(found, key=lambda x: -x[1])


def cutout(rgb: np.ndarray, mask: np.ndarray) -> bytes | None:
    """RGBA crop to the mask's box, transparent outside the mask, as PNG; None for an empty mask."""
    box = bounding_box(mask)
    if box is None:
        return None
    part = np.s_[box["y1"] : box["y2"] + 1, box["x1"] : box["x2"] + 1]
    return png.encode(np.dstack([rgb[part], np.where(mask[part] > 0, 255, 0).astype(np.uint8)]))


#: Capitals, digits and a few signs, three wide and five high; a digit is a row of pixels.
_GLYPHS = dict(
    pair.split(":")
    for pair in "A:25755 B:65656 C:34443 D:65556 E:74647 F:74644 G:34553 H:55755 I:72227 J:11152 K:55655 L:44447 M:57755 N:65555 O:25552 P:65644 Q:25573 R:65655 S:34216 T:72222 U:55557 V:55552 W:55775 X:55255 Y:55222 Z:71247 0:75557 1:26227 2:61247 3:61216 4:55711 5:74616 6:34757 7:71122 8:75757 9:75716 .:00002 -:00700 _:00007 /:11244".split()
)


def font_height(width: int, height: int) -> int:
    """Of labels: a fortieth of the shorter side, 16 at least."""
    shorter = height if height < width else width
    return max(16, shorter // 40)


def draw_text(image: np.ndarray, x: int, y: int, text: str, height: int, colour: tuple[int, int, int] = (255, 255, 0)) -> None:
    """Write text into an (h, w, 3) array in a plain pixel font, capitals only; what falls outside is cut off."""
    size = max(1, height // 5)
    for k, c in enumerate(text.upper()):
        rows = _GLYPHS.get(c)
        if rows is None:
            continue
        glyph = np.array([[int(r) >> b & 1 for b in (2, 1, 0)] for r in rows], bool).repeat(size, 0).repeat(size, 1)
        left = x + k * 4 * size
        part = image[max(0, y) : y + 5 * size, max(0, left) : left + 3 * size]
        part[glyph[: part.shape[0], : part.shape[1]]] = colour


def overlay(rgb: np.ndarray, masks: list[np.ndarray], labels: list[str] | None = None) -> tuple[bytes, int]:
    """Image with each mask in translucent red, its box in yellow and its label above, as PNG, and the number of masks
    drawn. Empty masks are passed over; an image without any says so."""
    h, w = rgb.shape[:2]
    out, drawn, font = rgb.astype(np.float64), 0, font_height(w, h)
    for m in masks:
        if m.any():
            a = OVERLAY_ALPHA / 255
            out[m > 0] = out[m > 0] * (1 - a) + np.array([255.0, 0.0, 0.0]) * a
            drawn += 1
    for n, m in enumerate(masks):
        if box := bounding_box(m):
            for k in range(BOX_WIDTH):
                y1, y2, x1, x2 = box["y1"] + k, box["y2"] - k, box["x1"] + k, box["x2"] - k
                if y1 <= y2 and x1 <= x2:
                    out[[y1, y2], x1 : x2 + 1] = (255, 255, 0)
                    out[y1 : y2 + 1, [x1, x2]] = (255, 255, 0)
            if labels:
                draw_text(out, box["x1"], max(0, box["y1"] - font - 12), labels[n], font)
    if not drawn:
        draw_text(out, 10, 10, "No detections", font)
    return png.encode(np.rint(out).astype(np.uint8)), drawn


def load_mask(data: bytes) -> np.ndarray:
    """A mask from the bytes of an .npy file."""
    return np.load(io.BytesIO(data), allow_pickle=False)
