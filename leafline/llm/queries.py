"""One query per operator on the driver's tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from leafline.llm import exact_dedup, lang_id, language_model, leaks, mixing, near_dup, periodic, sharding, token_scan, toxicity, url_rules, warc, whitening
from leafline.llm.text import crc_of, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            ORACLES[fn.__name__] = sql
        return fn

    return add


@query(
    f"""WITH t AS (SELECT doc_id, {LOWER_SQL} AS body FROM documents),
  g AS (SELECT body, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
  SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256 FROM t JOIN g USING (body)"""
)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.deduplicate(table(spark, sf_dir, "documents"))


@query()
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_of("doc_id") % 4 == 2
    found = lang_id.identify(docs, lang_id.fit(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


#: the rules of the url query: host, path, verdict
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def _url_sql() -> str:
    under = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
    order = sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
    rule = " ".join(f"WHEN {under.format(h, p)} THEN '{h}{p}'" for h, p, _ in order)
    verdict = " ".join(f"WHEN '{h}{p}' THEN '{v}'" for h, p, v in order)
    return rf"""WITH a AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
    FROM pages),
  b AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM a),
  c AS (SELECT *, CASE {rule} END AS rule FROM b)
  SELECT *, CASE rule {verdict} ELSE 'allow' END AS verdict FROM c"""


@query(_url_sql())
def op9_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = ", ".join(f"('{host}', '{path}', '{verdict}')" for host, path, verdict in URL_RULES)
    rules = spark.sql(f"SELECT * FROM VALUES {values} AS r(host, path, verdict)")
    return url_rules.judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


SHARDS = 24


@query()
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "row"
    )


@query()
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    held_out = crc_of("doc_id") % 3 == 1
    found = toxicity.score_documents(docs, toxicity.fit(docs.where(~held_out), labels))
    return found.select(
        "doc_id", held_out.alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"),
        F.size("passages").alias("n_passages"),
    )


@query()
def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_of("doc_id") % 5 == 1
    scored = language_model.score_documents(docs, *language_model.fit(docs.where(~held_out)))
    return scored.withColumn("held_out", held_out)


@query()
def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


@query(f"SELECT doc_id, len({WORDS_SQL}) AS n_tokens FROM documents")
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_scan.document_lengths(table(spark, sf_dir, "documents"))


@query()
def op6_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = leaks.decontaminate(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return found.select("doc_id", (F.size("leaks") > 0).alias("leaked"), F.col("leaks.item_id").alias("item_ids"))


@query()
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def with_planted_runs(docs: DataFrame) -> DataFrame:
    """(doc_id, text): in one of ten documents, by checksum of the id, the words
    from some place on are replaced by a repetition of those first ones."""
    h = crc_of("doc_id")
    g = F.floor(h / 10).cast("long")

    def repeated(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = F.floor((n - a) / (g % 8 + 3)).cast("long") + 1
        at = F.sequence(F.lit(0).cast("long"), n - 1)
        moved = F.transform(at, lambda i: F.get(words, F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")))
        return F.when(n > 0, F.array_join(moved, " "))

    # each document's words are made once, though looked up many times
    words = F.array(F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    planted = F.when(h % 10 == 0, F.get(F.transform(words, repeated), F.lit(0)))
    return docs.select("doc_id", F.coalesce(planted, F.col("text")).alias("text"))


@query()
def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic.find_runs(with_planted_runs(table(spark, sf_dir, "documents")))
    longest = F.transform("runs", lambda r: F.struct((-r.length).alias("k"), r.start.alias("start"), r.period.alias("period")))
    line = F.transform("runs", lambda r: F.concat_ws(",", r.start.cast("string"), r.length.cast("string"), r.period.cast("string")))
    lines = F.concat(F.array_join(line, "\n"), F.when(F.size("runs") > 0, "\n").otherwise(""))
    best = found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.get(F.sort_array(longest), F.lit(0)).alias("best"),
        F.sha2(lines, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
    length = -F.col("best.k")
    return best.select(
        "doc_id", "n_runs", F.col("best.start").alias("start"), length.alias("length"), F.col("best.period").alias("period"),
        F.expr("1000 * -best.k div best.period").alias("exponent_milli"), "runs_sha256", "collapsed_sha256",
    )


@query()
def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("""WITH p AS (SELECT page_id, coalesce(html, '') AS html, octet_length(encode(coalesce(html, ''))) AS payload_bytes FROM pages),
  r AS (SELECT *, CASE WHEN payload_bytes >= 1000 THEN max(page_id) OVER (PARTITION BY html) END AS first FROM p)
  SELECT page_id, payload_bytes, sha1(html) AS payload_digest, CASE WHEN page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to FROM r""")
def op13_web_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html")).drop("error")
