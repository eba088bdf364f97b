"""Landing of live pages: a host's links are read one after another by one task, hosts beside each other.

Politeness is a property of the host, so links are dealt out by host, and each host has a
:class:`~sijill.sources.fetch.Fetcher` of its own: its delay, attempts and robots rules. A link
with validators is asked for conditionally. A link that can't be had is a row with its reason,
and never ends the task.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from datetime import UTC, datetime

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.urls import host
from .fetch import Answer, Fetcher, FetchError

LANDED = "url string, status string, html string, etag string, last_modified string, fetched_at string, reason string"
NAMES = [f.split(" ")[0] for f in LANDED.split(", ")]
Transport = Callable[[str, dict[str, str], float], Answer]


def http(url: str, headers: dict[str, str], timeout: float) -> Answer:
    """A request by the standard library; an error status is an answer, a broken connection an OSError."""
    from urllib.error import HTTPError
    from urllib.parse import quote
    from urllib.request import Request, urlopen

    try:
        with urlopen(Request(quote(url, safe="%/:?#[]@!$&'()*+,;=~"), headers=headers), timeout=timeout) as got:
            return Answer(got.status, encoding=got.headers.get_content_charset(), headers=dict(got.headers), raw=got.read()).decoded()
    except HTTPError as error:
        return Answer(error.code, headers=dict(error.headers))


def land(links: DataFrame, transport: Transport = http, **polite) -> DataFrame:
    """url, status (ok, unchanged or failed), html, etag, last_modified, fetched_at, reason of links (ord, url[, etag, last_modified]).

    polite: what :class:`Fetcher` takes (delay, timeout, attempts, backoff, robots). Write the
    result before it is used: reading it twice asks twice.
    """
    none = F.lit(None).cast("string")
    marks = [F.col(n).alias(n) if n in links.columns else none.alias(n) for n in ("etag", "last_modified")]
    asked = links.select("url", host(F.col("url")).alias("host"), "ord", *marks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetchers: dict[str, Fetcher] = {}
        for b in batches:
            for r in b.to_pylist():
                own = fetchers.setdefault(r["host"], Fetcher(transport, **polite))
                now = datetime.now(UTC).isoformat(timespec="seconds")
                try:
                    page = own.fetch(r["url"], r["etag"], r["last_modified"])
                    row = (r["url"], "unchanged" if page.not_modified else "ok", page.html, page.etag, page.last_modified, now, None)
                except (FetchError, OSError, ValueError) as error:
                    row = (r["url"], "failed", None, None, None, now, str(error))
                yield pa.RecordBatch.from_arrays([pa.array([x], pa.string()) for x in row], names=NAMES)

    return asked.repartition("host").sortWithinPartitions("host", "ord").mapInArrow(run, LANDED)
