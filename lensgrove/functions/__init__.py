"""Scalar functions: Column in, Column out, all inside the JVM."""

from .arrays import any_of, all_of, drop_empty, drop_null_rgb, ordered_join, scores_text, sort_instances, top_scores
from .casts import lenient_float, lenient_int, to_long
from .logs import exit_code, hold_reason, log_events, seconds_between, tail_chars, tail_lines
from .text import artefact_name, batch_name, binomial, first_filled, image_name, int_list, marker, rgb_text, sanitize, score_text
from .urls import best_url, object_url, storage_ext, url_ext, value_ext

__all__ = [n for n in dir() if not n.startswith("_") and n not in ("arrays", "casts", "logs", "text", "urls")]
