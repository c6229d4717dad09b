"""URL filters as of the time of capture."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import col, require

#: (entry, day, action): what a public-style block list of this corpus's hosts looked like over time.
LIST = [
    ("spam-farm.example.org", "2023-01-10", "block"),
    ("spam-farm.example.org", "2023-08-01", "allow"),
    ("spam-farm.example.org", "2024-02-15", "block"),
    ("spam-farm.example.com", "2023-03-01", "block"),
    ("spam-farm.example.net", "2023-05-20", "block"),
    ("cheap-pills.example.com", "2023-02-01", "block"),
    ("cheap-pills.example.net", "2023-02-01", "block"),
    ("cheap-pills.example.org", "2023-06-11", "block"),
    ("casino-win.example.com", "2023-04-04", "block"),
    ("casino-win.example.com", "2024-06-01", "allow"),
    ("casino-win.example.net", "2023-04-04", "block"),
    ("casino-win.example.org", "2023-11-30", "block"),
    ("ads-track.example.com", "2023-01-01", "block"),
    ("ads-track.example.net", "2023-07-07", "block"),
    ("ads-track.example.org", "2024-01-01", "block"),
    ("adult-x.example.com", "2023-01-01", "block"),
    ("adult-x.example.net", "2023-01-01", "block"),
    ("adult-x.example.org", "2023-09-09", "block"),
    ("free-bets.example.net", "2023-12-24", "block"),
    ("free-bets.example.com", "2023-12-24", "block"),
    ("free-bets.example.org", "2024-05-05", "block"),
    ("tionsh.example.com/en", "2024-03-01", "block"),
    ("tionsh.example.com/en", "2024-09-01", "allow"),
    ("m.adult-x.example.com", "2024-01-01", "allow"),
    ("Shop.example.com/A", "2023-01-01", "block"),
]


def host(url: Column) -> Column:
    """Lower-case host of a URL without user, port and final dot; null if it has none."""
    rest = F.regexp_replace(url, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.lit(""))
    rest = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.nullif(F.lower(F.regexp_replace(F.regexp_replace(rest, F.lit("^.*@"), F.lit("")), F.lit(r"(:[0-9]*)?$|\.(:[0-9]*)?$"), F.lit(""))), F.lit(""))


def path(url: Column) -> Column:
    """Path of a URL with its first slash, without query and fragment; '' if it has none."""
    rest = F.regexp_replace(url, F.lit(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.lit(""))
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def keys(url: Column, labels: int, parts: int) -> Column:
    """All list entries of at most so many labels and path parts that would match a URL: each domain it lies in, alone
    and with each leading part of its path."""
    every = F.split(host(url), r"\.")
    own = F.slice(every, F.greatest(F.size(every) - labels, F.lit(0)) + 1, labels)
    domains = F.transform(F.sequence(F.lit(1), F.size(own)), lambda k: F.array_join(F.slice(own, k, F.size(own)), "."))
    steps = F.slice(F.filter(F.split(path(url), "/"), lambda p: p != ""), 1, max(1, parts))
    most = F.least(F.size(steps), F.lit(parts))
    paths = F.transform(F.sequence(F.lit(0), most), lambda k: F.when(k == 0, F.lit("")).otherwise(F.concat(F.lit("/"), F.array_join(F.slice(steps, F.lit(1), k), "/"))))
    return F.flatten(F.transform(domains, lambda d: F.transform(paths, lambda p: F.concat(d, p))))


def normal(entry: Column) -> Column:
    """A list entry as keys() writes it: its host in lower case, its path as it is, but for empty parts and a last slash."""
    tail = F.array_join(F.filter(F.split(F.regexp_extract(entry, r"^[^/]*(.*)$", 1), "/"), lambda p: p != ""), "/")
    return F.concat(F.lower(F.regexp_extract(entry, r"^([^/]*?)\.?(/|$)", 1)), F.when(tail != "", F.concat(F.lit("/"), tail)).otherwise(F.lit("")))


def intervals(listing: DataFrame) -> DataFrame:
    """(entry, action, valid_from, valid_to): each list row holds from its time to that of the entry's next row.

    Of rows of one entry and time, a block outlasts an allow; repeated rows count once; rows with a null entry or
    time are ignored. The last interval of an entry has no end. An empty list has no interval.
    """
    require(listing, "entry", "listed_at", "action")
    rows = listing.where("entry is not null and listed_at is not null").groupBy(normal(F.col("entry")).alias("entry"), "listed_at").agg(F.max("action").alias("action"))
    return rows.select("entry", "action", F.col("listed_at").alias("valid_from"), F.lead("listed_at").over(W.partitionBy("entry").orderBy("listed_at")).alias("valid_to"))


def filter_urls(pages: DataFrame, listing: DataFrame, *, page_id: str = "page_id", url: str = "url", fetched_at: str = "fetched_at") -> DataFrame:
    """(page_id, url, fetched_at, blocked, entry) for every row of ``pages``.

    listing: rows (entry, listed_at, action 'block' or 'allow'); an entry is a domain, for it and its subdomains,
    optionally with a leading part of a path. Rows become validity intervals; a capture is judged by the entries
    whose interval holds its fetch time, and of those by the longest one. ``entry`` is that entry, null if there is
    none; ``blocked`` is whether its action is 'block', and null if the URL or its fetch time is null.

    The join is an equi-join on entries plus a range on time, over distinct (url, fetch time) only, so that hot
    URLs count once. Its sides have known sizes, from which Spark picks a broadcast or a shuffle as it runs.
    A URL is looked up by as many labels and path parts as the list's longest entries have, so very long URLs cost no
    more than others. Hosts match whatever their case, paths only in theirs. Repeated rows and null ids stay as they
    are; other columns aren't read; empty pages give no rows, an empty list blocks nothing.
    """
    require(pages, page_id, url, fetched_at)
    rows = pages.select(col(page_id).alias("page_id"), col(url).alias("url"), col(fetched_at).alias("fetched_at"))
    captures = rows.where("url is not null and fetched_at is not null").select("url", "fetched_at").distinct()
    valid = intervals(listing)
    size = listing.where("entry is not null").select(normal(F.col("entry")).alias("e")).agg(F.max(F.regexp_count("e", F.lit("/"))), F.max(F.size(F.split("e", r"\.")))).first()
    asked = captures.select("url", "fetched_at", F.explode(keys(F.col("url"), size[1] or 1, size[0] or 0)).alias("key"))
    hit = asked.join(valid, (asked.key == valid.entry) & (asked.fetched_at >= valid.valid_from) & (valid.valid_to.isNull() | (asked.fetched_at < valid.valid_to)))
    best = hit.groupBy("url", "fetched_at").agg(F.max_by(F.struct("entry", "action"), F.struct(F.length("entry"), "entry")).alias("best"))
    judged = rows.join(best, ["url", "fetched_at"], "left")
    blocked = F.when(F.col("url").isNotNull() & F.col("fetched_at").isNotNull(), F.coalesce(F.col("best.action") == "block", F.lit(False)))
    return judged.select("page_id", "url", "fetched_at", blocked.alias("blocked"), F.col("best.entry").alias("entry"))


def with_fetch_time(pages: DataFrame) -> DataFrame:
    """pages with the day on which this synthetic crawl fetched each: two years of days from 2023, by page_id."""
    return pages.select("page_id", "url", F.expr("timestamp_ntz '2023-01-01 00:00:00' + make_dt_interval(cast(pmod(page_id, 730) as int))").alias("fetched_at"))


def filter_urls_sql(table: str = "pages", listing: list[tuple[str, str, str]] = LIST) -> str:
    """The rows of filter_urls(with_fetch_time(pages), LIST) as DuckDB SQL."""
    values = ", ".join(f"('{e}', TIMESTAMP '{d} 00:00:00', '{a}')" for e, d, a in listing)
    scheme = "'^[A-Za-z][A-Za-z0-9+.-]*://'"
    return rf"""
    WITH listing AS (SELECT * FROM (VALUES {values}) v(entry, listed_at, action)),
    valid AS (SELECT entry, action, listed_at AS valid_from, lead(listed_at) OVER (PARTITION BY entry ORDER BY listed_at) AS valid_to
              FROM (SELECT lower(regexp_extract(entry, '^([^/]*?)\.?(/|$)', 1)) || regexp_extract(regexp_replace(entry, '/+', '/', 'g'), '^[^/]*(.*?)/?$', 1) AS entry, listed_at, max(action) AS action FROM listing GROUP BY 1, 2)),
    rows AS (SELECT page_id, url, TIMESTAMP '2023-01-01 00:00:00' + to_days(CAST(page_id % 730 AS INTEGER)) AS fetched_at FROM {table}),
    split AS (SELECT DISTINCT url, fetched_at,
                lower(regexp_replace(regexp_replace(regexp_extract(regexp_replace(url, {scheme}, ''), '^([^/?#]*)', 1), '^.*@', ''), '(:[0-9]*)?$|\.(:[0-9]*)?$', '')) AS host,
                list_filter(string_split(regexp_extract(regexp_replace(url, {scheme}, ''), '^[^/?#]*([^?#]*)', 1), '/'), lambda p: p <> '') AS parts
              FROM rows WHERE url IS NOT NULL AND fetched_at IS NOT NULL),
    domains AS (SELECT url, fetched_at, parts, unnest(list_transform(range(1, len(string_split(host, '.')) + 1), lambda k: array_to_string(string_split(host, '.')[k:], '.'))) AS domain FROM split),
    asked AS (SELECT url, fetched_at, unnest(list_transform(range(0, len(parts) + 1), lambda k: domain || CASE WHEN k = 0 THEN '' ELSE '/' || array_to_string(parts[1:k], '/') END)) AS key FROM domains),
    hit AS (SELECT DISTINCT ON (a.url, a.fetched_at) a.url, a.fetched_at, v.entry, v.action FROM asked a JOIN valid v
            ON a.key = v.entry AND a.fetched_at >= v.valid_from AND (v.valid_to IS NULL OR a.fetched_at < v.valid_to)
            ORDER BY a.url, a.fetched_at, length(v.entry) DESC, v.entry DESC)
    SELECT r.page_id, r.url, r.fetched_at, CASE WHEN r.url IS NOT NULL AND r.fetched_at IS NOT NULL THEN coalesce(h.action = 'block', false) END AS blocked, h.entry
    FROM rows r LEFT JOIN hit h ON r.url = h.url AND r.fetched_at = h.fetched_at"""
