"""License scans: lookup of canonical digests of whole texts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import col, require
from .license_texts import LICENSES

#: Lines that name an owner, in lower case; they differ from copy to copy of one licence.
OWNER_LINE = r"(?m)^[ \t*#/;>-]*(copyright|\(c\)|©|all rights reserved)[^\n]*$"
#: Word starts that are spelled in two ways, first to second, once only letters, digits and single spaces are left.
SPELLINGS = [
    ("licence", "license"),
    ("sublicence", "sublicense"),
    ("sub license", "sublicense"),
    ("licencing", "licensing"),
    ("organisation", "organization"),
    ("recognise", "recognize"),
    ("favour", "favor"),
    ("fulfil ", "fulfill "),
    ("acknowledgement", "acknowledgment"),
    ("judgement", "judgment"),
    ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"),
    ("merchantibility", "merchantability"),
    ("whilst", "while"),
    ("https ", "http "),
    ("copyright owner", "copyright holder"),
]


def canonical(text: Column) -> Column:
    """Lower-case words of a text, single spaces between, without owner lines and in one spelling; null stays null."""
    out = F.lower(F.regexp_replace(text, F.lit("\r\n?"), F.lit("\n")))
    out = F.regexp_replace(out, F.lit(OWNER_LINE), F.lit(""))
    out = F.concat(F.lit(" "), F.regexp_replace(out, F.lit(r"[^\p{L}\p{N}]+"), F.lit(" ")), F.lit(" "))
    for a, b in SPELLINGS:
        out = F.replace(out, F.lit(" " + a), F.lit(" " + b))
    return F.trim(out)


def canonical_sql(text: str) -> str:
    """The same as DuckDB SQL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    out = rf"lower(regexp_replace({text}, '\r\n?', chr(10), 'g'))"
    out = f"regexp_replace({out}, {quote(OWNER_LINE)}, '', 'g')"
    out = rf"(' ' || regexp_replace({out}, '[^\p{{L}}\p{{N}}]+', ' ', 'g') || ' ')"
    for a, b in SPELLINGS:
        out = f"replace({out}, {quote(' ' + a)}, {quote(' ' + b)})"
    return f"trim({out})"


def scan_licenses(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", known: Sequence[tuple[str, str]] = LICENSES) -> DataFrame:
    """(doc_id, digest, license_id) for every row: the SHA-256 of its canonical text, and the licence that has it.

    Texts match whole: a licence inside a longer text isn't one. ``license_id`` is null if no known licence has the
    digest. If two identifiers share a canonical text, the first in alphabetical order is given, so that no row
    repeats. A null text has a null digest and no licence; an empty text, and one of owner lines or punctuation
    only, has the digest of the empty string, which is no licence's. Repeated rows and null ids stay as they are.
    """
    require(docs, text, doc_id)
    spark = docs.sparkSession
    table = spark.createDataFrame(list(known), "license_id string, body string").select(F.sha2(canonical(F.col("body")), 256).alias("known_digest"), "license_id")
    table = table.where(F.col("known_digest") != F.sha2(F.lit(""), 256)).groupBy("known_digest").agg(F.min("license_id").alias("license_id"))
    signed = docs.select(col(doc_id).alias("doc_id"), F.sha2(canonical(col(text)), 256).alias("digest"))
    # the list is small and its size known to the planner, which picks a broadcast or a shuffled hash join by it
    return signed.join(table, signed.digest == table.known_digest, "left").select("doc_id", "digest", "license_id")


def scan_licenses_sql(table: str = "documents", known: Sequence[tuple[str, str]] = LICENSES) -> str:
    """The same rows as DuckDB SQL."""
    values = ", ".join("('" + i + "', '" + t.replace("'", "''") + "')" for i, t in known)
    return f"""
    WITH known AS (SELECT sha256({canonical_sql('body')}) AS digest, min(license_id) AS license_id
                   FROM (VALUES {values}) v(license_id, body) GROUP BY 1 HAVING digest <> sha256(''))
    SELECT d.doc_id, d.digest, k.license_id
    FROM (SELECT doc_id, sha256({canonical_sql('text')}) AS digest FROM {table}) d LEFT JOIN known k ON d.digest = k.digest"""
