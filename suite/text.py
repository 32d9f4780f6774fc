"""Words, counts, vocabulary, TF-IDF and topics."""

from pyspark.sql import functions as F

from leafline.functions import text as X
from leafline.operators import title_words as T
from leafline.operators import vectors as V
from leafline.plans import topics as P
from leafline.session import materialize
from suite.frames import (
    COMMENTS_SQL,
    DOCUMENTS_SQL,
    bag_sql,
    conversation_comments,
    document_comments,
    vectors_ctes,
    vocabulary_ctes,
    words_sql,
)
from suite.registry import case, table


@case("SELECT doc_id, trim(regexp_replace(text, '[^A-Za-z0-9가-힣]', ' ', 'g')) AS cleaned FROM documents")
def clean_text(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.clean_text(F.col("text")).alias("cleaned"))


@case("""SELECT doc_id, array_to_string(list_filter(string_split_regex(
    trim(regexp_replace(lower(text), '[^A-Za-z0-9가-힣]', ' ', 'g')), ' +'), lambda w: length(w) > 1), ' ') AS words
  FROM documents""")
def tokenize(spark, sf):
    words = X.tokenize(F.col("text"), lower=True)
    return table(spark, sf, "documents").select("doc_id", F.array_join(words, " ").alias("words"))


@case(bag_sql(DOCUMENTS_SQL))
def bag_of_words(spark, sf):
    return V.bag_of_words(V.with_bag(document_comments(spark, sf), lower=True))


@case(f"""WITH bag AS ({bag_sql(DOCUMENTS_SQL, lower=False)}),
  n AS (SELECT source AS t_id, count(*) AS n_docs FROM (SELECT DISTINCT source, text FROM documents) GROUP BY 1),
  once AS (SELECT source AS t_id, min(doc_id) AS comment_pos FROM documents GROUP BY source, text),
  df AS (SELECT t_id, term, count(*) AS df FROM bag JOIN once USING (t_id, comment_pos) GROUP BY ALL)
  SELECT t_id, term, df, n_docs FROM df JOIN n USING (t_id) WHERE df >= 1 AND df <= floor(0.7::DOUBLE * n_docs)""")
def df_filter(spark, sf):
    return T.title_terms(T.title_documents(document_comments(spark, sf)))


@case(f"WITH {vocabulary_ctes(DOCUMENTS_SQL)} SELECT term, tf FROM vocab")
def top_terms(spark, sf):
    return V.vocabulary(V.with_bag(document_comments(spark, sf), lower=True)).select("term", "tf")


@case(f"WITH {vocabulary_ctes(DOCUMENTS_SQL)} SELECT term, df, n_docs, round(idf, 6) AS idf FROM vocab")
def smooth_idf(spark, sf):
    vocab = V.vocabulary(V.with_bag(document_comments(spark, sf), lower=True))
    return vocab.select("term", "df", "n_docs", F.round("idf", 6).alias("idf"))


@case(f"""WITH {vocabulary_ctes(DOCUMENTS_SQL)}, {vectors_ctes()}
  SELECT t_id, comment_pos, term, round(w, 6) AS weight FROM vectors""")
def tfidf_l2(spark, sf):
    bags = V.with_bag(document_comments(spark, sf), lower=True)
    return V.tfidf(bags, V.vocabulary(bags)).select("t_id", "comment_pos", "term", F.round("weight", 6).alias("weight"))


@case(f"""WITH {vocabulary_ctes(DOCUMENTS_SQL)}
  SELECT t_id, comment_pos, term, n FROM bag WHERE term IN (SELECT term FROM vocab)""")
def vocab_semi_join(spark, sf):
    bags = V.with_bag(document_comments(spark, sf), lower=True)
    return V.restrict_to_vocabulary(V.bag_of_words(bags), V.vocabulary(bags)).select("t_id", "comment_pos", "term", "n")


@case(words_sql(COMMENTS_SQL, lower=False))
def title_tokens(spark, sf):
    comments = conversation_comments(spark, sf)
    return comments.select("t_id", "comment_pos", F.explode(X.tokenize(F.col("comment"))).alias("term"))


_DTM = f"""WITH src AS (SELECT t_id, min(comment_pos) AS comment_pos, comment FROM ({{source}}) GROUP BY t_id, comment),
  bag AS ({bag_sql('SELECT * FROM src', lower=False)}),
  n AS (SELECT t_id, count(*) AS n_docs FROM src GROUP BY 1),
  kept AS (SELECT t_id, term FROM bag JOIN n USING (t_id) GROUP BY t_id, term, n_docs
    HAVING count(*) <= floor(0.7::DOUBLE * n_docs))"""
_BY_ROLE_SQL = "SELECT 'N' || conv_id || role AS t_id, turn AS comment_pos, text AS comment FROM conversations"


@case(f"{_DTM.replace("{source}", COMMENTS_SQL)} SELECT t_id, comment_pos, term, n FROM bag SEMI JOIN kept USING (t_id, term)")
def title_dtm(spark, sf):
    docs = materialize(T.title_documents(conversation_comments(spark, sf)), "title-documents")
    return T.title_dtm(docs, T.dropped_terms(docs)).select("t_id", "comment_pos", "term", "n")


@case(f"{_DTM.replace("{source}", _BY_ROLE_SQL)} SELECT DISTINCT t_id FROM src ANTI JOIN kept USING (t_id)")
def topic_skipped(spark, sf):
    by_role = table(spark, sf, "conversations").select(
        F.concat(F.lit("N"), F.col("conv_id").cast("string"), F.col("role")).alias("t_id"),
        F.col("turn").alias("comment_pos"),
        F.col("text").alias("comment"),
    )
    docs = T.title_documents(by_role)
    return T.skipped_titles(docs, T.title_terms(docs))


@case(f"{_DTM.replace("{source}", COMMENTS_SQL)} SELECT DISTINCT t_id, true AS few, true AS own FROM bag SEMI JOIN kept USING (t_id, term)")
def title_topics(spark, sf):
    """Every title with a kept word has one to three topic words, all different
    and all among its kept words."""
    comments = conversation_comments(spark, sf)
    docs = materialize(T.title_documents(comments), "title-documents")
    terms = T.title_terms(docs).select("t_id", "term")
    found = materialize(P.title_topics(comments), "topics")
    own = found.select("t_id", F.explode("t_topics").alias("term")).join(terms, ["t_id", "term"], "left_semi")
    own = own.groupBy("t_id").agg(F.countDistinct("term").alias("n"))
    size = F.size("t_topics")
    return found.join(own, "t_id").select("t_id", size.between(1, 3).alias("few"), (size == F.col("n")).alias("own"))


def title_topic_words(spark, sf):
    """The topic words themselves, which SQL cannot say."""
    return P.title_topics(conversation_comments(spark, sf))


_READOUT_SQL = """words AS (SELECT t_id, comment_pos, term, n FROM bag SEMI JOIN kept USING (t_id, term)),
  tf AS (SELECT t_id, term, sum(n) AS tf FROM words GROUP BY ALL),
  alltf AS (SELECT term, sum(tf) AS all_tf FROM tf GROUP BY 1),
  topics AS (SELECT unnest(range(3)) AS i),
  mean AS (SELECT t_id, i, avg(((comment_pos + 1) * (i + 2)) % 5) AS m FROM (SELECT DISTINCT t_id, comment_pos FROM words), topics GROUP BY ALL),
  best AS (SELECT t_id, i, term, row_number() OVER (PARTITION BY t_id, i
    ORDER BY ((length(term) * (i + 1)) % 7 + 1)::DOUBLE * (tf / all_tf) DESC, term) AS r FROM tf JOIN alltf USING (term), topics),
  placed AS (SELECT t_id, term, min(struct_pack(m := -m, i := i)) AS place FROM best JOIN mean USING (t_id, i) WHERE r = 1 GROUP BY ALL)
  SELECT t_id, array_to_string(list(term ORDER BY place), '|') AS topics FROM placed GROUP BY 1"""


@case(f"{_DTM.replace("{source}", COMMENTS_SQL)}, {_READOUT_SQL}")
def topic_readout(spark, sf):
    """The read-out with weights and shares given by formulas."""
    docs = materialize(T.title_documents(conversation_comments(spark, sf)), "title-documents")
    kept = materialize(T.keep_terms(docs, T.dropped_terms(docs)).where(F.size("bag") > 0), "title-words")
    dtm = T.words_of(kept, ("t_id",))
    weight = [(F.length("term") * (i + 1) % 7 + 1).cast("double") for i in range(3)]
    share = [((F.col("comment_pos") + 1) * (i + 2) % 5).cast("double") for i in range(3)]
    terms = dtm.select("term").distinct().withColumn("weights", F.array(*weight))
    shares = kept.select("t_id", F.array(*share).alias("share"), F.lit(1).alias("m"))
    return P.topic_readout(dtm, terms, shares, 3).select("t_id", F.array_join("t_topics", "|").alias("topics"))
