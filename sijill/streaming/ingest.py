"""The import as a stream of landed pages: captures are shed by keyed state, the rest is merged into the corpus by folders.

State is kept for each canonical URL: the capture that counts (its time, digest and entity
tag) and the first time it was seen. A capture that repeats the one that counts, or is
older, goes no further, in whichever batch it comes; so a replayed batch and one out of order
leave the corpus as one run over all rows does (a name that two documents want stays with
the one that has it). The order in which names are claimed is that of first captures.

A batch rewrites the folders that it touches (:mod:`sijill.sources.store`). One that is
repeated after a failure merges the same rows again. The checkpoint is the resume log;
``availableNow`` makes a run of what has landed.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..functions.urls import canonical_url
from ..plans.ingest import plan
from ..sources import store
from ..sources.tables import discard, kept

PAGES = "url string, html string, etag string, last_modified string, fetched_at string"
CAPTURE = "url string, html string, etag string, last_modified string, fetched_at string, digest string, first string"
STATE = "fetched_at string, digest string, etag string, first string"


def _plain(x) -> str | None:
    return None if x is None or x != x else str(x)


def newest(key: tuple, parts: Iterable[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """The capture of a URL that counts, if it is later than the one in the state (null times are earliest, equal ones go by digest) and differs from it. One capture is held at a time."""
    had = state.get if state.exists else None
    best, first = None, had[3] if had else None
    for part in parts:
        for row in part.itertuples(index=False):
            at = _plain(row.fetched_at) or ""
            first = at if first is None else min(first, at)
            if best is None or (at, row.digest) > (_plain(best.fetched_at) or "", best.digest):
                best = row
    at, digest, etag = _plain(best.fetched_at) or "", best.digest, _plain(best.etag)
    if had and (at, digest) <= (had[0], had[1]):
        state.update((*had[:3], first))
        return
    state.update((at, digest, etag, first))
    if had is None or (etag != had[2] if etag and had[2] else digest != had[1]):
        yield pd.DataFrame([[key[0], best.html, etag, _plain(best.last_modified), _plain(best.fetched_at), digest, first]], columns=CAPTURE.replace(" string", "").split(", "))


def captures(pages: DataFrame) -> DataFrame:
    """The captures of a stream of pages that tell something new, in update mode."""
    own = pages.select(canonical_url(F.col("url")).alias("url"), "html", "etag", "last_modified", "fetched_at", F.sha2(F.coalesce("html", F.lit("")), 256).alias("digest"))
    return own.groupBy("url").applyInPandasWithState(newest, CAPTURE, STATE, "update", GroupStateTimeout.NoTimeout)


def merge_batch(rows: DataFrame, batch: int, root: str) -> None:
    """A batch of captures into the corpus at ``root``; pages that give no document are a table ``failed`` beside it, by batch."""
    spark = rows.sparkSession
    store.repair(spark, root, "repaired")
    pages = kept(rows, "stream-captures")
    links = pages.select(F.coalesce(F.unix_micros(F.try_to_timestamp("first")), F.lit(0).cast("long")).alias("ord"), "url")
    current = kept(store.read(spark, root).select("url", "path", "text").join(links.select("url"), "url", "left_semi"), "stream-current")
    tables = [pages, current]

    def keep(df: DataFrame, name: str) -> DataFrame:
        tables.append(kept(df, f"stream-{name}"))
        return tables[-1]

    made = plan(links, pages, current, keep=keep)
    store.merge(spark, root, made.incoming, f"batch-{batch:012d}")
    made.results.where("status = 'failed'").select("url", "reason").write.mode("overwrite").parquet(f"{root}/failed/batch={batch:012d}")
    discard(*tables)


def run(spark: SparkSession, landing: str, root: str) -> StreamingQuery:
    """Starts a run over the Parquet files in ``landing``."""
    pages = spark.readStream.schema(PAGES).parquet(landing)
    write = captures(pages).writeStream.outputMode("update").foreachBatch(lambda rows, batch: merge_batch(rows, batch, root))
    return write.option("checkpointLocation", f"{root}/_checkpoint").trigger(availableNow=True).start()
