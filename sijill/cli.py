"""Commands over a corpus folder and landed pages (a Parquet table of url, html)."""

from __future__ import annotations

import argparse
import contextlib
import hashlib
import os
import shutil
import sys
import uuid
from datetime import datetime

from pyspark.sql import Observation, SparkSession
from pyspark.sql import functions as F

from .functions.frontmatter import read_text, set_field, set_list
from .functions.urls import canonical_url
from .operators import corpus, parse, quality, render, report
from .plans.ingest import plan
from .sources import files, headers, landing, robots, sitemap, tables
from .sources.registry import get


#: How live pages are asked for.
TRANSPORT = landing.http
#: Where a report goes that is asked for without a place.
REPORT = os.path.join("logs", "summary.md")


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="sijill")
    sub = p.add_subparsers(dest="command", required=True)
    add = lambda name, *args: [c := sub.add_parser(name), [c.add_argument(*a, **k) for a, k in args]][0]
    out, dry = (("--out",), {"default": "laws"}), (("--dry-run",), {"action": "store_true"})
    add("import", out, (("urls",), {"nargs": "*"}), (("--pages",), {}), (("--from-file",), {}), (("--done",), {}), (("--failed",), {}), (("--resume",), {"action": "store_true"}), (("--check-updates",), {"action": "store_true"}), (("--limit",), {"type": int}), (("--category",), {}), (("--report",), {"nargs": "?", "const": REPORT}), (("--discover",), {"nargs": "?", "const": ""}), (("--maps",), {}), (("--include-updates",), {"action": "store_true"}), (("--html",), {}), (("--source",), {}), (("--url",), {}), (("--robots",), {}), (("--ignore-robots",), {"action": "store_true"}), (("--delay",), {"type": float, "default": 1.5}), (("--timeout",), {"type": float, "default": 30}))
    add("discover", (("--maps",), {"required": True}), (("--source",), {"required": True}), (("--include-updates",), {"action": "store_true"}), (("--to",), {}))
    for name in ("reclassify", "audit-duplicates", "canonicalize-urls"):
        add(name, out, dry)
    add("lint", out, (("--strict",), {"action": "store_true"}))
    add("index", out, (("--to",), {"default": "index.json"}), (("--check",), {"action": "store_true"}))
    add("smoke", (("--pages",), {"required": True}))
    return p


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("sijill").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    return globals()[f"_{args.command.replace('-', '_')}"](spark, args)


@contextlib.contextmanager
def _settled(df, root: str):
    """``df`` as a table beside the corpus, while files that it was made from are changed."""
    at = os.path.join(root, f"_settled-{uuid.uuid4().hex}")
    try:
        df.write.parquet(at)
        yield df.sparkSession.read.schema(df.schema).parquet(at)
    finally:
        shutil.rmtree(at, ignore_errors=True)


def _current(spark: SparkSession, root: str):
    read = files.read_corpus(spark, root)
    return read.select(canonical_url(read_text(F.col("text"), "source_url")).alias("url"), "path", "text").where("url is not null")


def _pages(spark: SparkSession, args):
    """Landed pages, or one local file of HTML in their place."""
    if not args.html:
        return spark.read.parquet(args.pages)
    with open(args.html, encoding="utf-8") as f:
        return spark.createDataFrame([(args.url or "", f.read())], "url string, html string")


def _live(spark: SparkSession, args, keep):
    """Lands the pages of links as they are asked for; what the corpus has validators of, conditionally where updates are checked."""
    index = files.source_index(files.read_corpus(spark, args.out)).select("url", "etag", "last_modified") if args.check_updates else None

    def pages(links):
        asked = links if index is None else links.join(index, "url", "left")
        return keep(landing.land(asked, TRANSPORT, delay=args.delay, timeout=args.timeout, robots=not args.ignore_robots), f"landed-{uuid.uuid4().hex}")

    return pages


def _with_refused(results, refused, limited: bool):
    """Results with the links that robots rules forbid, as failures; with a limit those before its end."""
    if limited:
        refused = refused.join(F.broadcast(results.agg(F.max("ord").alias("last"))), F.col("ord") <= F.col("last")).drop("last")  # one row
    none = F.lit(None).cast("string")
    why = F.concat(F.lit("robots.txt يمنع جلب "), "url")
    return results.unionByName(refused.select("ord", "url", F.lit("failed").alias("status"), none.alias("title"), none.alias("doc_type"), why.alias("reason"), F.expr("cast(array() as array<string>)").alias("warnings")))


def _say_failed(maps, source, updates: bool) -> None:
    """Submaps that are listed and can't be read, one a line."""
    for r in sitemap.failed(maps, source.sitemap, source.hosts, updates).toLocalIterator():
        print(f"تعذّر جلب خريطة فرعية {r.url}: {r.reason}", file=sys.stderr)


def _import(spark: SparkSession, args) -> int:
    """Everything that is read of the corpus is settled in a folder of its own before the first file is changed: new texts are written, then old paths removed, then the logs."""
    discovered = None if args.discover is None else [s.strip() for s in (args.discover or args.source or "").split(",") if s.strip()]
    if args.html and not (args.url or args.source) or discovered is not None and not (args.maps and discovered):
        print("--html needs --url or --source, --discover needs sources and --maps", file=sys.stderr)
        return 2
    if args.html and args.source:
        get(args.source, parse.SOURCES)
    own = spark.createDataFrame(list(enumerate([*args.urls, *([args.url or ""] if args.html else [])])), "ord int, url string")
    lists = [own, *([files.read_links(spark, args.from_file)] if args.from_file else [])]
    for name in discovered or []:
        try:
            source = get(name, parse.SOURCES)
        except ValueError as error:  # the other sources are imported all the same
            print(f"{name}: {error}", file=sys.stderr)
            continue
        maps = spark.read.parquet(args.maps)
        _say_failed(maps, source, args.include_updates)
        lists.append(sitemap.discover(maps, source.sitemap, source.hosts, args.include_updates))
    links = files.union_links(*lists)
    staging = os.path.join(args.out, f"_import-{uuid.uuid4().hex}")

    def keep(df, name: str):
        df.write.parquet(f"{staging}/{name}")
        return spark.read.schema(df.schema).parquet(f"{staging}/{name}")

    state = os.path.join(args.out, "_refresh")
    known = spark.read.parquet(state) if os.path.isdir(state) else spark.createDataFrame([], "url string, etag string, digest string")
    try:
        current = keep(_current(spark, args.out), "current")
        done = files.read_done(spark, args.done) if args.done and os.path.exists(args.done) else None
        if args.resume and not args.check_updates:  # what the corpus has is looked at again where updates are
            seen = current.select("url")
            done = seen if done is None else done.unionByName(seen)
        refused = None
        if args.robots and not args.ignore_robots:  # landed files: host, status, text
            judged = keep(robots.judge(links, robots.rules(spark.read.parquet(args.robots))), "judged")
            links, refused = judged.where("allowed").select("ord", "url"), judged.where("not allowed").select("ord", "url")
            refused = refused if done is None else corpus.resume(refused, done)
        pages = _pages(spark, args) if args.html or args.pages else _live(spark, args, keep)
        made = plan(links, pages, current, done, args.category, known if args.check_updates else None, keep, args.limit, args.source if args.html else None)
        results = keep(made.results if refused is None else _with_refused(made.results, refused, bool(args.limit)), "results")
        taken = made.merged.join(results.select("url"), "url", "left_semi")
        changed = keep(taken.where("action in ('added', 'updated', 'moved')"), "changed")
        marks = made.marks.join(results.where("status = 'ok'").select("url"), "url", "left_semi")
        marks = keep(marks.unionByName(known.join(marks.select("url"), "url", "left_anti")), "marks")
        skipped = links.count() - made.asked.count()
        render.export(changed, args.out)
        render.remove(changed.where("action = 'moved'").select(F.col("old_path").alias("path")).join(changed.select("path"), "path", "left_anti"), args.out)
        marks.write.mode("overwrite").parquet(state)
        stamp = datetime.now().isoformat(timespec="seconds")
        failed = F.concat_ws("\t", F.lit(stamp), "url", F.coalesce("reason", F.lit("")))
        for log, status, line in ((args.done, "status <> 'failed'", F.col("url")), (args.failed, "status = 'failed'", failed)):
            if log:
                files.append_lines((r.line for r in results.where(status).orderBy("ord").select(line.alias("line")).toLocalIterator()), log)
        if args.report:
            os.makedirs(os.path.dirname(os.path.abspath(args.report)), exist_ok=True)
            with open(args.report, "w", encoding="utf-8") as f:
                report.write_summary(results, stamp, f, skipped)
        report.write_summary(results, stamp, sys.stdout, skipped)
        return int(not results.where("status = 'failed'").isEmpty())
    finally:
        shutil.rmtree(staging, ignore_errors=True)


def _discover(spark: SparkSession, args) -> int:
    source, maps = get(args.source, parse.SOURCES), spark.read.parquet(args.maps)
    _say_failed(maps, source, args.include_updates)
    found = sitemap.discover(maps, source.sitemap, source.hosts, args.include_updates).orderBy("ord")
    n = 0
    with open(args.to, "w", encoding="utf-8") if args.to else contextlib.nullcontext(sys.stdout) as out:
        for n, r in enumerate(found.toLocalIterator(), 1):
            print(r.url, file=out)
    return int(not n)


def _reclassify(spark: SparkSession, args) -> int:
    read = files.fields(files.read_corpus(spark, args.out)).withColumn("is_decision", F.col("text").rlike(corpus.CLAUSE_HEADING) & ~F.col("text").rlike(corpus.ARTICLE_HEADING))
    moves = corpus.reclassify(read)
    counts = Observation("actions")
    moves = moves.observe(counts, *(F.count_if(F.col("action") == a).alias(a) for a in corpus.ACTIONS))
    if args.dry_run:
        moves.write.format("noop").mode("overwrite").save()
    else:
        text = set_field(set_field(F.col("text"), "doc_type", F.col("new_type")), "category", F.col("new_category"))
        due = moves.where("action in ('move', 'fields')").join(read.select("path", "text"), "path").select("path", "new_path", "action", text.alias("text"))
        with _settled(due, args.out) as due:
            render.export(due.select(F.col("new_path").alias("path"), "text"), args.out)
            render.remove(due.where("action = 'move'").select("path"), args.out)
    for action, n in counts.get.items():
        if n:
            print(action, n)
    return 0


def _audit_duplicates(spark: SparkSession, args) -> int:
    read = files.fields(files.read_corpus(spark, args.out))
    sets, counts = corpus.sibling_sets(read), Observation("siblings")
    due = tables.kept(sets.observe(counts, F.count("*").alias("files"), F.count_if("touched").alias("touched")).where("touched").select("path", "title"), "siblings-due")
    print(counts.get["files"], counts.get["touched"])
    if not args.dry_run:
        due = corpus.siblings(read).join(due.select("path"), "path", "left_semi")
        with _settled(due.join(read.select("path", "text"), "path").select("path", set_list(F.col("text"), "also_available_from", F.col("siblings")).alias("text")), args.out) as made:
            render.export(made, args.out)
    return 0


def _canonicalize_urls(spark: SparkSession, args) -> int:
    read = files.fields(files.read_corpus(spark, args.out))
    counts = Observation("changes")
    due = corpus.canonicalise(read).observe(counts, F.count_if("url_changed").alias("urls"), F.count_if("list_changed").alias("lists")).where("url_changed or list_changed")
    if args.dry_run:
        due.write.format("noop").mode("overwrite").save()
    else:
        text = set_list(set_field(F.col("text"), "source_url", F.col("source_url")), "also_available_from", F.col("also_available_from"))
        with _settled(due.join(read.select("path", "text"), "path").select("path", text.alias("text")), args.out) as made:
            render.export(made, args.out)
    print(counts.get["urls"], counts.get["lists"])
    return 0


def _lint(spark: SparkSession, args) -> int:
    read = files.read_corpus(spark, args.out)
    found = quality.lint(read)
    for r in found.orderBy("path", "severity", "rule", "ord").toLocalIterator():
        print(f"{r.severity}: {r.path}: {r.message}")
    return int(quality.lint_summary(found, read, args.strict).first().failed)


def _digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.file_digest(f, "sha256").hexdigest()


def _index(spark: SparkSession, args) -> int:
    """The index file, and beside it a table of its ranges with their digests: a check compares those, and the file's own digest, and writes nothing."""
    entries, ranges = report.index(headers.fields(headers.read_headers(spark, args.out))), f"{args.to}.ranges"
    if not args.check:
        report.write_index(entries, args.to)
        report.write_ranges(entries, ranges)
        with open(os.path.join(ranges, "file.sha256"), "w", encoding="utf-8") as f:
            f.write(_digest(args.to))
        return 0
    mark = os.path.join(ranges, "file.sha256")
    if not (os.path.exists(args.to) and os.path.exists(mark)) or open(mark, encoding="utf-8").read() != _digest(args.to):
        return 1
    found = report.changes(entries, ranges)
    n = 0
    for n, r in enumerate(found.orderBy("path", "change").toLocalIterator(), 1):
        print(f"{r.change}: {r.path}")
    return int(bool(n))


def _smoke(spark: SparkSession, args) -> int:
    pages = spark.read.parquet(args.pages)
    bad = quality.canary(parse.parse(pages)).collect()
    for r in bad:
        print(r.url, r.reason)
    return int(bool(bad))


if __name__ == "__main__":
    sys.exit(main())
