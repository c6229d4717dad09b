"""A keyset-paginated source: batch and stream readers over one page function."""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.parse
import urllib.request
from array import array
from collections.abc import Callable, Iterator
from itertools import islice

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from lensgrove import schemas

PER_PAGE = 200
PAUSE_S = 1.1
RETRY_STATUS = (429, 500, 502, 503, 504)


class FileTransport:
    """Pages cut from JSON-lines observations, a file or a folder of files; what a server with the same rows would answer.

    The files are read once for the ids and places of their lines, and again when they have changed; a page then reads
    its own lines. A page ends where an id does, so rows that share one are on the same page.
    """

    def __init__(self, path: str):
        self.path, self.seen = path, None

    def _files(self) -> list[str]:
        if not os.path.isdir(self.path):
            return [self.path]
        return [e.path for e in sorted(os.scandir(self.path), key=lambda e: e.name) if e.is_file() and e.name[0] not in "._"]

    def _index(self) -> None:
        """ids in their order; at: (file, begin, end) of each one's line."""
        files = self._files()
        seen = [(f, (s := os.stat(f)).st_size, s.st_mtime_ns) for f in files]
        if seen == self.seen:
            return
        ids, at = array("q"), array("q")
        for k, path in enumerate(files):
            with open(path, "rb") as f:
                begin = 0
                for line in f:
                    end = begin + len(line)
                    if line.strip() and (key := json.loads(line).get("id")) is not None:
                        ids.append(int(key))
                        at.extend((k, begin, end))
                    begin = end
        keys = np.frombuffer(ids, np.int64)
        order = np.argsort(keys, kind="stable")
        self.seen, self.files, self.ids, self.at = seen, files, keys[order], np.frombuffer(at, np.int64).reshape(-1, 3)[order]

    def _end(self, begin: int, per_page: int) -> int:
        """Where the page that begins at a place in ids ends."""
        if begin + per_page >= len(self.ids):
            return len(self.ids)
        return int(np.searchsorted(self.ids, self.ids[begin + per_page - 1], "right"))

    def page(self, id_above: int, per_page: int) -> list[dict]:
        self._index()
        begin = int(np.searchsorted(self.ids, id_above, "right"))
        return list(read_lines(self.files, self.at[begin : self._end(begin, per_page)]))

    def parts(self, id_above: int, per_page: int, rows: int = 5000) -> list[Pages]:
        """All pages after an id, in parts of whole pages with about ``rows`` rows, which can be read apart."""
        self._index()
        first = begin = int(np.searchsorted(self.ids, id_above, "right"))
        number, ends, out = 1, [], []
        while begin < len(self.ids):
            begin = self._end(begin, per_page)
            ends.append(begin - first)
            if begin - first >= rows or begin == len(self.ids):
                out.append(Pages(number, ends, self.files, self.at[first:begin]))
                number, ends, first = number + len(ends), [], begin
        return out


class Pages(InputPartition):
    """Consecutive pages of files: the first one's number, where each ends among their lines, and the lines' places."""

    def __init__(self, number: int, ends: list[int], files: list[str], at: np.ndarray):
        self.number, self.ends, self.at = number, ends, at.copy()
        self.files = {int(k): files[k] for k in np.unique(at[:, 0])}

    def __iter__(self) -> Iterator[tuple[int, list[dict]]]:
        rows = read_lines(self.files, self.at)
        for k, end in enumerate(self.ends):
            yield self.number + k, list(islice(rows, end - (self.ends[k - 1] if k else 0)))


def read_lines(files, at: np.ndarray) -> Iterator[dict]:
    """The JSON lines at (file, begin, end), in that order; one file is open at a time."""
    now, f = None, None
    try:
        for k, begin, end in at.tolist():
            if k != now:
                if f:
                    f.close()
                now, f = k, open(files[k], "rb")
            f.seek(begin)
            yield json.loads(f.read(end - begin))
    finally:
        if f:
            f.close()


class HttpTransport:
    """Pages of a web service: eight tries, waiting longer each time; a 429 waits ten seconds first."""

    def __init__(self, url: str, query: dict[str, str], tries: int = 8, backoff: float = 1.5, timeout: float = 60.0, opener=urllib.request.urlopen, sleep=time.sleep):
        self.url, self.query, self.tries, self.backoff, self.timeout, self.opener, self.sleep = url, query, tries, backoff, timeout, opener, sleep

    def fetch(self, url: str) -> bytes:
        """The body of a GET; raises the last error if no try succeeds."""
        for k in range(self.tries):
            try:
                with self.opener(urllib.request.Request(url, headers={"Accept": "*/*"}), timeout=self.timeout) as r:
                    return r.read()
            except urllib.error.HTTPError as e:
                if e.code not in RETRY_STATUS or k == self.tries - 1:
                    raise
                self.sleep(10.0 if e.code == 429 else self.backoff * 2**k)
            except urllib.error.URLError:
                if k == self.tries - 1:
                    raise
                self.sleep(self.backoff * 2**k)
        raise AssertionError("unreachable")

    def page(self, id_above: int, per_page: int) -> list[dict]:
        asked = self.query | {"order_by": "id", "order": "asc", "per_page": str(per_page)}
        if id_above > 0:
            asked["id_above"] = str(id_above)
        return json.loads(self.fetch(f"{self.url}?{urllib.parse.urlencode(asked)}")).get("results") or []


def pages(transport, id_above: int = 0, per_page: int = PER_PAGE, pause: float = 0.0, most: int | None = None) -> Iterator[tuple[int, list[dict]]]:
    """(page number, rows) until a page is empty or none of its rows has an id; the last id is the next cursor."""
    number = 0
    while most is None or number < most:
        rows = transport.page(id_above, per_page)
        if not rows:
            return
        number += 1
        yield number, rows
        ids = [r["id"] for r in rows if r.get("id") is not None]
        if not ids:
            return
        id_above = ids[-1]
        if pause:
            time.sleep(pause)


def _converter(kind) -> Callable:
    """A function of a JSON value that gives the type's value, or None for what isn't one."""
    from pyspark.sql import types as T

    if isinstance(kind, T.StructType):
        fields = [(f.name, _converter(f.dataType)) for f in kind.fields]
        return lambda v: tuple(None if (x := v.get(n)) is None else c(x) for n, c in fields) if isinstance(v, dict) else None
    if isinstance(kind, T.ArrayType):
        each = _converter(kind.elementType)
        return lambda v: [None if x is None else each(x) for x in v] if isinstance(v, list) else None
    if isinstance(kind, T.BooleanType):
        return lambda v: v if isinstance(v, bool) else None
    number = int if isinstance(kind, (T.LongType, T.IntegerType)) else float if isinstance(kind, T.DoubleType) else None
    if number is None:
        return lambda v: v if isinstance(v, str) else json.dumps(v)

    def convert(v):
        try:
            return number(v)
        except (TypeError, ValueError):
            return None

    return convert


def _row_maker(fields) -> Callable[[int, int, dict], tuple]:
    """(page, place on it, observation) as a row of the source's schema."""
    from pyspark.sql import types as T

    convert = _converter(T.StructType(fields.fields[2:]))
    return lambda number, pos, r: (number, pos, *convert(r))


def _transport(options: dict):
    if path := options.get("path"):
        return FileTransport(path)
    skip = {"url", "perpage", "pause", "idabove", "pagesperbatch"}
    return HttpTransport(options["url"], {k: v for k, v in options.items() if k.lower() not in skip})


class _Reader(DataSourceReader):
    def __init__(self, schema, options):
        self.fields, self.options = schema, dict(options)

    def partitions(self):
        o, transport = self.options, _transport(self.options)
        if isinstance(transport, FileTransport):
            return transport.parts(int(o.get("idabove", 0)), int(o.get("perpage", PER_PAGE))) or [InputPartition(0)]
        return [InputPartition(0)]  # each page's cursor is the last id of the one before

    def read(self, partition):
        o, make = self.options, _row_maker(self.fields)
        if isinstance(partition, Pages):
            found = partition
        else:
            found = pages(_transport(o), int(o.get("idabove", 0)), int(o.get("perpage", PER_PAGE)), float(o.get("pause", 0)))
        for number, rows in found:
            for pos, r in enumerate(rows):
                yield make(number, pos, r)


class _StreamReader(SimpleDataSourceStreamReader):
    def __init__(self, schema, options):
        self.fields, self.options = schema, dict(options)
        self.transport, self.make = _transport(self.options), _row_maker(schema)  # kept: it knows where its pages lie

    def initialOffset(self):
        return {"id_above": int(self.options.get("idabove", 0))}

    def _rows(self, start: dict, upto: int | None = None):
        o, out, last = self.options, [], start["id_above"]
        for number, rows in pages(self.transport, last, int(o.get("perpage", PER_PAGE)), float(o.get("pause", 0)), int(o.get("pagesperbatch", 1)) if upto is None else None):
            for pos, r in enumerate(rows):
                if upto is not None and (r.get("id") is None or r["id"] > upto):
                    return out, {"id_above": upto}
                out.append(self.make(number, pos, r))
                last = r.get("id") or last
        return out, {"id_above": last}

    def read(self, start):
        rows, end = self._rows(start)
        return iter(rows), end

    def readBetweenOffsets(self, start, end):
        return iter(self._rows(start, end["id_above"])[0])

    def commit(self, end):
        pass


class PagedObservations(DataSource):
    """Format 'paged_observations'. Options: path (JSON lines, a file or a folder) or url with the service's own parameters; perPage,
    pause, idAbove, and pagesPerBatch for streams. Rows have their page's number and their place on it."""

    @classmethod
    def name(cls):
        return "paged_observations"

    def schema(self):
        from pyspark.sql import types as T

        return T.StructType([T.StructField("page", T.IntegerType()), T.StructField("pos", T.IntegerType()), *schemas.API_OBSERVATION.fields])

    def _lower(self):
        return {k.lower(): v for k, v in self.options.items()}

    def reader(self, schema):
        return _Reader(schema, self._lower())

    def simpleStreamReader(self, schema):
        return _StreamReader(schema, self._lower())


def register(spark: SparkSession) -> None:
    """Make the format known to a session."""
    spark.dataSource.register(PagedObservations)


def resume_cursor(done: DataFrame, key: str = "observation_id") -> int:
    """The id after which to go on: the largest that is there, 0 for none. Texts that are no integers are ignored."""
    return done.agg(F.coalesce(F.max(F.col(key).try_cast("bigint")), F.lit(0))).first()[0]
