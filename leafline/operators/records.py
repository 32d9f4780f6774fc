"""Raw records of both sites to the canonical tables."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.functions import fields as X

# canonical column <- column of the raw table
RUNNING_N = {
    "t_id": "t_index", "site": "site", "title": "t_names", "weekdays": "t_weekdays", "author": "t_auth",
    "genre": "t_genre", "story_line": "story_line", "thumb": "t_thumbs", "url": "t_urls",
}
FINISHED_N = {k: v for k, v in RUNNING_N.items() if k != "weekdays"}
RUNNING_K = {
    "t_id": "t_id", "site": "site", "title": "title", "weekdays": "day", "author": "author",
    "genre": "genre", "story_line": "story_line", "thumb": "picUrl", "url": "url",
}
COMMENTS_N = {"t_id": "t_index", "best_comments": "t_comments"}
COMMENTS_K = {"t_id": "t_id", "best_comments": "best_comments"}

# Column order of the site-N working tables.
ORDER_RUNNING_N = [
    "t_index", "site", "t_weekdays", "t_names", "t_auth", "t_genre", "t_age", "t_sum", "t_thumbs", "t_urls", "t_comments",
]
ORDER_FINISHED_N = [c for c in ORDER_RUNNING_N if c not in ("t_weekdays", "t_comments")]


def rename(df: DataFrame, mapping: Mapping[str, str], extra: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*[F.col(old).alias(new) for new, old in mapping.items()], *extra)


def key_prefix_sql(df: DataFrame, prefix: str, raw_id: str, key: str = "t_id") -> DataFrame:
    """All columns and the global key, as a SQL statement over the frame."""
    return df.sparkSession.sql(f"SELECT *, CONCAT('{prefix}', {raw_id}) AS {key} FROM {{t}}", t=df)


def key_prefix(df: DataFrame, prefix: str, raw_id: str, key: str = "t_index") -> DataFrame:
    """The global key in place of the raw one."""
    return df.withColumn(key, X.title_key(prefix, F.col(raw_id))).drop(raw_id)


def project_sql(spark: SparkSession, view: str, *columns: str) -> DataFrame:
    """Columns of a registered view."""
    return spark.sql(f"SELECT {', '.join(columns)} FROM {view}")


def reorder(df: DataFrame, columns: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    return df.select(*columns, *extra)


def prepare_n(raw: DataFrame, running: bool = True, split_authors: bool = False) -> DataFrame:
    """Site N: key, site tag, genre list, column order, story line; the snapshot
    day stays beside them. Authors stay text unless asked to be split."""
    df = key_prefix(raw, X.N_PREFIX, "t_IDs").withColumns(
        {"site": F.lit(X.N_SITE), "t_genre": X.split_comma(F.col("t_genre"))}
    )
    if split_authors:
        df = df.withColumn("t_auth", X.split_authors(F.col("t_auth")))
    columns = ORDER_RUNNING_N if running else ORDER_FINISHED_N
    return reorder(df, columns, ("snapshot_date",)).withColumn("story_line", F.col("t_sum"))


def prepare_k(raw: DataFrame) -> DataFrame:
    """Site K: key, genre list, one author field, site tag."""
    return (
        key_prefix_sql(raw, X.K_PREFIX, "id")
        .withColumns(
            {
                "genre": X.split_slash(F.col("genre")),
                "author": X.merged_author(F.col("story_writer"), F.col("illustrator")),
                "site": F.lit(X.K_SITE),
            }
        )
        .drop("story_writer", "illustrator")
    )


def explode_comments(comments: DataFrame, array: str = "best_comments", keys: tuple[str, ...] = ("t_id",)) -> DataFrame:
    """(keys, comment_pos, comment): one row per comment. Titles without comments
    and missing entries vanish; the position settles ties later on."""
    rows = comments.select(*keys, F.posexplode(array).alias("comment_pos", "comment"))
    return rows.where(F.col("comment").isNotNull())


def nonempty_comments(df: DataFrame, array: str = "best_comments") -> DataFrame:
    return df.where(X.has_items(F.col(array)))


def union_sites(n: DataFrame, k: DataFrame) -> DataFrame:
    return n.unionByName(k)
