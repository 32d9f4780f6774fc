import re

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, size string, row int, h int, score int, leaks int, n int"


def frame(spark, rows):
    """Documents from (doc_id, text, lang, source), with columns that clash with results."""
    return spark.createDataFrame([(*r, 1, "x", 2, 3, 4, 5, 6) for r in rows], SCHEMA)


LONG = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))

ODD = [
    (1, "The quick brown fox jumps over the lazy dog and runs far away", "en", "a"),
    (1, "The quick brown fox jumps over the lazy dog and runs far away", "en", "a"),
    (2, "THE quick brown fox jumps over the lazy dog and runs far away", "en", "b"),
    (3, None, "en", "a"),
    (4, "", None, None),
    (5, " \t\n", "fr", None),
    (6, "123 !?", "fr", "b"),
    (None, "le petit chat dort sur la table de la maison", "fr", "c"),
    (None, None, None, None),
    (7, "É", "fr", "c"),
    (8, LONG, "en", "a"),
    (-9, "le petit chat dort sur la table de la maison", "fr", "c"),
    (9, "three words only", "en", "c"),
]


def words(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def empty(spark):
    return frame(spark, [])


def ids(rows):
    return sorted((r.doc_id for r in rows), key=lambda x: (x is None, x))


ALL = sorted((r[0] for r in ODD), key=lambda x: (x is None, x))
