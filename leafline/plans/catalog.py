"""Title info of running and finished titles, and comments, of both sites.

Each takes raw snapshot rows with `snapshot_date` and an anchor day, and is one
lazy plan: a scan per site, and one shuffle where rows per key are cut to one.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafline.operators import records as R
from leafline.operators.ranking import latest_per_key
from leafline.sources.snapshots import BACK, FINISHED_OFFSET, at_offset, lookback


def _newest(df: DataFrame) -> DataFrame:
    """The newest snapshot's row per title; of rows of one day the first in the
    order of their content, so that the choice is the same on every run. Rows
    without a key are no title's."""
    content = [F.asc_nulls_first(c) for c in df.columns if c not in ("t_id", "snapshot_date")]
    titled = df.where(F.col("t_id").isNotNull())
    return latest_per_key(titled, "t_id", [F.col("snapshot_date").desc(), *content]).drop("snapshot_date")


def info_n(raw: DataFrame, anchor: date, back: int = BACK) -> DataFrame:
    prepared = R.prepare_n(lookback(raw, anchor, back))
    return _newest(R.rename(prepared, R.RUNNING_N, ("snapshot_date",)))


def info_k(raw: DataFrame, anchor: date, back: int = BACK) -> DataFrame:
    prepared = R.prepare_k(lookback(raw, anchor, back).drop("best_comments", "key_words"))
    return _newest(R.rename(prepared, R.RUNNING_K, ("snapshot_date",)))


def title_info(
    raw_n: DataFrame, raw_k: DataFrame, anchor: date, anchor_k: date | None = None, back: int = BACK
) -> DataFrame:
    """Canonical info, one row per title. The sites may be anchored apart."""
    return R.union_sites(info_n(raw_n, anchor, back), info_k(raw_k, anchor_k or anchor, back))


def finished_info(raw: DataFrame, anchor: date, offset: int = FINISHED_OFFSET) -> DataFrame:
    """Canonical info of finished titles, from the snapshot `offset` days back."""
    prepared = R.prepare_n(at_offset(raw, anchor, offset), running=False)
    return _newest(R.rename(prepared, R.FINISHED_N, ("snapshot_date",)))


def comments(
    raw_n: DataFrame,
    raw_k: DataFrame,
    anchor: date,
    anchor_k: date | None = None,
    back: int = BACK,
    latest: bool = False,
) -> DataFrame:
    """(t_id, best_comments): every snapshot row of the lookback, or only the
    newest per title with `latest`."""
    n = R.rename(
        R.key_prefix(lookback(raw_n, anchor, back), "N", "t_IDs"), R.COMMENTS_N, ("snapshot_date",)
    )
    k = R.rename(
        R.key_prefix(lookback(raw_k, anchor_k or anchor, back), "K", "id", "t_id"), R.COMMENTS_K, ("snapshot_date",)
    )
    both = R.union_sites(n, k)
    return _newest(both) if latest else both.drop("snapshot_date")


def keyword_reviews(raw_k: DataFrame) -> DataFrame:
    """(t_id, best_comments, key_words) of site K."""
    return R.key_prefix_sql(raw_k, "K", "id").select("t_id", "best_comments", "key_words")
