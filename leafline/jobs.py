"""The daily jobs, from snapshot files to a new version of each stored table.

    python -m leafline.jobs info --n-base s3a://bucket/n/ --k-base s3a://bucket/k/ \\
        --anchor 2024-03-10 --table s3a://bucket/tables/info --version 12

A job reads the table's version before the one it writes, if there is one
(version 1 starts a table), puts the day's items in, and writes the new version
in parallel; nothing passes through the driver.
"""

from __future__ import annotations

import argparse
import logging
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline import schemas as SC
from leafline.functions.dates import COMPACT, DASHED
from leafline.operators import records as R
from leafline.plans import catalog, crawl, recommend, topics
from leafline.session import build_session, clear_scratch, materialize
from leafline.sources import snapshots as S
from leafline.sources.reruns import observed
from leafline.sources.sinks import read_weekday_csv
from leafline.sources.upsert import publish, read_version, upsert

log = logging.getLogger("leafline.jobs")


def _put(spark: SparkSession, updates: DataFrame, key: str, table: str, version: int) -> str:
    """Updates hold one row per key."""
    if version == 1:
        path = publish(updates.where(f"{key} IS NOT NULL"), table, version)
    else:
        path = publish(upsert(read_version(spark, table, version - 1), updates, key), table, version)
    clear_scratch(spark)
    return path


def _readable(days: DataFrame, anchor: date, rejects: str | None) -> DataFrame:
    """The rows that could be read. Broken ones are appended to the folder
    `rejects`; a broken anchor day stops the job. A day is often one line, so one
    broken element may stand for the whole day."""
    broken = F.col(SC.CORRUPT).isNotNull()
    counted, seen = observed(
        days, rows=F.count(F.lit(1)), rejects=F.count_if(broken), days=F.collect_set("snapshot_date"),
        bad_days=F.collect_set(F.when(broken, F.col("snapshot_date"))),
    )
    good, bad = S.split_corrupt(materialize(counted, "days"))
    found = seen.get  # taken by the write itself
    log.info("%d rows, %d rejects, days %s", found["rows"], found["rejects"], ", ".join(map(str, sorted(found["days"]))))
    if found["rejects"]:
        if rejects is not None:
            bad.select("snapshot_date", SC.CORRUPT).write.mode("append").parquet(rejects)
        if anchor in found["bad_days"]:
            raise ValueError(f"broken records on {anchor}; see {rejects}")
    return good


def _lookback(spark: SparkSession, base: str, schema, anchor: date, style: str, rejects: str | None) -> DataFrame:
    return _readable(S.scan_lookback(spark, base, schema, anchor, style, keep_corrupt=True), anchor, rejects)


def _rejects(table: str) -> str:
    return table.rstrip("/") + "-rejects"


def info_job(spark: SparkSession, n_base: str, k_base: str, anchor: date, table: str, version: int) -> str:
    n = _lookback(spark, n_base, SC.N_RUNNING, anchor, COMPACT, _rejects(table))
    k = _lookback(spark, k_base, SC.K_JSON, anchor, DASHED, _rejects(table))
    return _put(spark, catalog.title_info(n, k, anchor), "t_id", table, version)


def finished_job(spark: SparkSession, base: str, anchor: date, table: str, version: int) -> str:
    """Into the table of running titles, whose items it replaces as a whole."""
    raw = S.scan_offset(spark, base, SC.N_FINISHED, anchor, COMPACT, keep_corrupt=True)
    raw = _readable(raw, anchor - timedelta(days=S.FINISHED_OFFSET), _rejects(table))
    return _put(spark, catalog.finished_info(raw, anchor), "t_id", table, version)


def comments_job(spark: SparkSession, n_base: str, k_base: str, anchor: date, table: str, version: int) -> str:
    n = _lookback(spark, n_base, SC.N_RUNNING, anchor, COMPACT, _rejects(table))
    k = _lookback(spark, k_base, SC.K_JSON, anchor, DASHED, _rejects(table))
    return _put(spark, catalog.comments(n, k, anchor, latest=True), "t_id", table, version)


def topics_job(spark: SparkSession, n_base: str, anchor: date, table: str, version: int) -> str:
    raw = _lookback(spark, n_base, SC.N_RUNNING, anchor, COMPACT, _rejects(table))
    comments = R.rename(R.key_prefix(raw, "N", "t_IDs"), R.COMMENTS_N)
    rows = R.explode_comments(R.nonempty_comments(comments))
    return _put(spark, topics.topic_items(topics.title_topics(rows)), "t_index", table, version)


def pages_job(spark: SparkSession, pages: str, listing: str, base: str, day: date) -> str:
    """Stored pages (page_id, url, html) of a day's titles and of the listing, in
    Parquet, to the day's JSON snapshot of site N."""
    anchors = crawl.P.page_anchors(spark.read.parquet(listing))
    records = crawl.daily_records(spark.read.parquet(pages), anchors)
    path = f"{base}{day.strftime(COMPACT)}.json"
    records.select(*SC.N_RUNNING.fieldNames()).write.json(path)
    return path


def csv_job(spark: SparkSession, csv: str, base: str, day: date) -> str:
    """A crawled weekday CSV to the day's JSON snapshot of site K."""
    path = f"{base}{day.strftime(DASHED)}.json"
    read_weekday_csv(spark, csv).select(*SC.K_JSON.fieldNames()).write.json(path)
    return path


def recommend_job(
    spark: SparkSession, n_base: str, k_base: str, anchor_n: date, anchor_k: date, reviewed: str,
    fav_genres: list[str], review: str,
) -> DataFrame:
    """From the snapshots, all days' comments counting; the sites may be anchored
    on different days."""
    n = _lookback(spark, n_base, SC.N_RUNNING, anchor_n, COMPACT, None)
    k = _lookback(spark, k_base, SC.K_JSON, anchor_k, DASHED, None)
    rows = R.explode_comments(catalog.comments(n, k, anchor_n, anchor_k))
    return recommend.recommend_titles(catalog.title_info(n, k, anchor_n, anchor_k), rows, reviewed, fav_genres, review)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("job", choices=["info", "finished", "comments", "topics", "recommend", "pages", "csv"])
    parser.add_argument("--n-base", help="path up to the day, e.g. s3a://bucket/n/")
    parser.add_argument("--k-base", help="the same for site K")
    parser.add_argument("--anchor", type=date.fromisoformat, required=True)
    parser.add_argument("--anchor-k", type=date.fromisoformat)
    parser.add_argument("--table")
    parser.add_argument("--version", type=int)
    parser.add_argument("--source", help="stored pages, or the crawled CSV")
    parser.add_argument("--listing", help="stored listing pages")
    parser.add_argument("--reviewed")
    parser.add_argument("--genre", action="append", default=[])
    parser.add_argument("--review")
    a = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    spark = build_session(f"leafline-{a.job}")
    if a.job == "info":
        info_job(spark, a.n_base, a.k_base, a.anchor, a.table, a.version)
    elif a.job == "finished":
        finished_job(spark, a.n_base, a.anchor, a.table, a.version)
    elif a.job == "comments":
        comments_job(spark, a.n_base, a.k_base, a.anchor, a.table, a.version)
    elif a.job == "topics":
        topics_job(spark, a.n_base, a.anchor, a.table, a.version)
    elif a.job == "pages":
        pages_job(spark, a.source, a.listing, a.n_base, a.anchor)
    elif a.job == "csv":
        csv_job(spark, a.source, a.k_base, a.anchor)
    else:
        recommend_job(
            spark, a.n_base, a.k_base, a.anchor, a.anchor_k or a.anchor, a.reviewed, a.genre, a.review
        ).show(truncate=False)


if __name__ == "__main__":
    main()
