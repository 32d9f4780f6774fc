"""Table schemas. Ids are text everywhere, so that a day which stores them as
numbers reads the same as one which stores them as strings."""

from pyspark.sql.types import ArrayType, DateType, IntegerType, StringType, StructField, StructType

CORRUPT = "_corrupt_record"


def _table(*fields: str) -> StructType:
    """`name` is a string column, `name[]` an array of strings."""
    return StructType(
        [
            StructField(f[:-2], ArrayType(StringType())) if f.endswith("[]") else StructField(f, StringType())
            for f in fields
        ]
    )


def with_corrupt(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField(CORRUPT, StringType())])


def dated(schema: StructType) -> StructType:
    return StructType([*schema.fields, StructField("snapshot_date", DateType())])


# Column names of the stored daily files.
N_RUNNING = _table(
    "t_IDs", "t_weekdays[]", "t_names", "t_auth", "t_genre", "t_age", "t_sum", "t_thumbs", "t_urls", "t_comments[]"
)
N_FINISHED = _table("t_IDs", "t_names", "t_auth", "t_genre", "t_age", "t_sum", "t_thumbs", "t_urls")
K_JSON = _table(
    "id", "url", "picUrl", "genre", "view", "like", "on_serial", "day[]", "title", "story_writer", "illustrator",
    "publisher", "story_line", "key_words[]", "best_comments[]",
)
# CSV carries lists as text, hence plain strings here.
K_CSV_WEEKDAY = _table(
    "serial", "url", "pic", "genre", "view", "like", "on_serial", "day", "title", "story_writer", "illustrator",
    "publisher", "story_line", "key_words", "best_comments",
)
K_CSV_COMPLETED = _table(
    "serial", "url", "pic", "genre", "view", "like", "on_serial", "title", "story_writer", "illustrator",
    "publisher", "story_line", "key_words", "best_comments",
)

TITLE_INFO_COLUMNS = ["t_id", "site", "title", "weekdays", "author", "genre", "story_line", "thumb", "url"]
FINISHED_INFO_COLUMNS = [c for c in TITLE_INFO_COLUMNS if c != "weekdays"]

TITLE_INFO = StructType(
    [
        StructField("t_id", StringType()),
        StructField("site", IntegerType()),
        StructField("title", StringType()),
        StructField("weekdays", ArrayType(StringType())),
        StructField("author", StringType()),
        StructField("genre", ArrayType(StringType())),
        StructField("story_line", StringType()),
        StructField("thumb", StringType()),
        StructField("url", StringType()),
    ]
)
REVIEWS = _table("user_id", "t_id", "fav_genres[]", "review")
