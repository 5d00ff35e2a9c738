"""Queries of the operators, for ``__spark_entry__.py``: each reads its whole
table and derives the columns of its contract from the operator's output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from qtrail.llm import ann_multi_index as ann
from qtrail.llm import chat_format as chat
from qtrail.llm import (license_scan, ngram_join, packing, piece_lattice, quality_ordinal, source_divergence, spotsigs, token_counts,
                        toxicity_pu, warc_zip, whitening)

from qtrail.llm.common import ship_package

TOKEN_LIMIT = 1024
SAID = "<|im_end|><|im_start|>assistant ok"  # both turns of conversation -1
KEEP_FROM = 0.5  # tail probability from which a document is kept


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = SAID
    extra = spark.sql("SELECT CAST(conv_id AS BIGINT) conv_id, CAST(turn AS BIGINT) turn, role, text FROM VALUES "
                      "(-1, 0, 'user', :said), (-1, 1, 'assistant', :said) AS t(conv_id, turn, role, text)",
                      args={"said": said})
    return chat.read_back(chat.format_conversations(turns.unionByName(extra))).drop("n_tokens")


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"))
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id",
                         "offset")


def op3_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.linked_components(table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = token_counts.token_counts(table(spark, sf_dir, "documents"))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def quality_ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Grades from the labels: 0 for junk, 1 for sound but toxic text, 2 for
    sound text; the tail from grade 1 is what ``quality`` marks."""
    return table(spark, sf_dir, "labels").select("doc_id", (
        F.col("quality") + F.col("quality") * (1 - F.coalesce("toxic", F.lit(0)))).alias("grade"))


def op5_quality_ordinal(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality_ordinal.train(docs, quality_ratings(spark, sf_dir).where(toxicity_pu.fold() != 0))
    graded = quality_ordinal.grade_documents(docs, model)
    return graded.select("row.doc_id", "expected_grade", "tail_probability",
                         (F.col("tail_probability") >= KEEP_FROM).alias("kept"))


def op6_piece_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    decoded = piece_lattice.decode(piece_lattice.encode(table(spark, sf_dir, "documents")))
    return decoded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids",
                          F.sha2("text", 256).alias("decoded_sha256"))


def op7_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


def op8_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    anchor = spotsigs.anchors(docs)
    rows = spotsigs.edited(spotsigs.with_next(docs, anchor=anchor))
    rows = spotsigs.with_signatures(rows, {"edited_signatures": "edited_text"}, anchor)
    return rows.select(
        "doc_id", "n_chars", F.sha2(F.col("edited_text"), 256).alias("edited_sha256"),
        spotsigs.written(F.col("signatures")).alias("fingerprint"),
        spotsigs.written(F.col("edited_signatures")).alias("edited_fingerprint"),
        spotsigs.likeness(F.col("signatures"), F.col("edited_signatures")).alias("near_edited"),
        spotsigs.likeness(F.col("signatures"), F.col("next_signatures")).alias("near_next"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc_zip.archive_round_trip(table(spark, sf_dir, "pages"), with_payload=False)
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_pu.train(docs, table(spark, sf_dir, "labels"))
    scored = toxicity_pu.score_documents(docs, model).select("row.doc_id", "score")
    return scored.select("doc_id", (toxicity_pu.fold() == 0).alias("held_out"), "score",
                         (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    pairs, terms = source_divergence.divergence(table(spark, sf_dir, "documents"))
    columns = ("lang", "source", "part", "item", "value", "rank")
    return (pairs.withColumn("part", F.lit("pair")).select(*columns)
            .unionByName(terms.withColumn("part", F.lit("term")).select(*columns)))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    scanned = license_scan.scan(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    starts = F.transform(base, lambda s: s["first"])

    def joined(spans):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(spans, lambda s: s["label"]))), ",")

    return scanned.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), joined(base).alias("base_labels"), joined(F.col("spans")).alias("labels"),
        F.coalesce(F.array_max(F.transform("spans", lambda s: s["share"])), F.lit(0.0)).alias("score"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A deviation past 64 bits is null here; the operator's is exact."""
    return whitening.whiten(table(spark, sf_dir, "embeddings")).withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of ``corpus_pipeline.py`` over ``documents``."""
    import corpus_pipeline
    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (
        op1_chat_format, op2_packing, op3_ngram_join, op4_token_counts, op5_quality_ordinal, op6_piece_lattice, op7_multi_index, op8_spotsigs,
        op9_warc, op10_toxicity, op11_source_divergence, op12_license_scan,
        op13_whitening, pipeline)}


def oracle_sql() -> dict[str, str]:
    """Only what SQL can express: tokenizers, models and fingerprints by hash it
    can't."""
    return {"op1_chat_format": OP1_SQL, "op3_ngram_join": OP3_SQL, "op9_warc": OP9_SQL, "op11_source_divergence": OP11_SQL}


# A control string grows by one backslash where it occurs in a turn; a turn
# stands between its two marks, with a line feed behind the role.
OP1_SQL = f"""
WITH t AS (
  SELECT conv_id, turn, COALESCE(role, '') AS role, COALESCE(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '{SAID}' UNION ALL SELECT -1, 1, 'assistant', '{SAID}'),
e AS (
  SELECT *, length(regexp_replace(text, '<(\\\\*)\\|', '<|\\1.', 'g')) AS text_chars,
    length(regexp_replace(replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n'),
      '<(\\\\*)\\|', '<|\\1.', 'g')) AS role_chars FROM t)
SELECT conv_id, COUNT(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(SUM(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(SUM(length('{chat.START}{chat.END}') + 1 + role_chars + text_chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

OP3_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 5 THEN array_to_string(ws, ' ') ELSE array_to_string(ws[i:i + 4], ' ') END AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - 3))) AS i FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, COUNT(*) AS n FROM s GROUP BY 1),
links AS (
  SELECT a, b FROM (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS c FROM s x JOIN s y ON x.sh = y.sh AND x.doc_id <> y.doc_id
    GROUP BY 1, 2) JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, COALESCE(n.n, 0) AS n_shingles, r.component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, MIN(b) AS component_id FROM reach GROUP BY 1) r USING (doc_id)
"""

# The largest page_id of equal payloads of 1000 bytes and more is the response.
OP9_SQL = """
SELECT page_id, CAST(strlen(h) AS BIGINT) AS payload_bytes, sha1(h) AS payload_digest,
  CASE WHEN page_id < last_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id < last_id THEN last_id END AS refers_to
FROM (SELECT page_id, h, CASE WHEN strlen(h) >= 1000 THEN MAX(page_id) OVER (PARTITION BY h) ELSE page_id END AS last_id
  FROM (SELECT page_id, COALESCE(html, '') AS h FROM pages))
"""


_SHARE = "(1 + (1000000000::HUGEINT * ({n} + 2)) // ({total} + 2 * v))"
OP11_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS id, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
    regexp_extract_all(translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS ts
  FROM documents),
occ AS (SELECT id, lang, source, unnest(ts) AS term FROM d),
kept AS (SELECT lang, term, COUNT(*) AS n FROM occ GROUP BY 1, 2 HAVING COUNT(DISTINCT id) >= 10),
cnt AS (SELECT o.lang, o.source, o.term, COUNT(*) AS n FROM occ o JOIN kept k ON o.lang = k.lang AND o.term = k.term
  GROUP BY 1, 2, 3),
grp AS (SELECT DISTINCT lang, source FROM d),
lang_of AS (SELECT lang, SUM(n) AS lang_n, COUNT(*) AS v FROM kept GROUP BY 1),
own AS (SELECT lang, source, SUM(n) AS group_n FROM cnt GROUP BY 1, 2),
shares AS (
  SELECT g.lang, g.source, k.term, COALESCE(c.n, 0) AS n,
    {_SHARE.format(n="COALESCE(c.n, 0)", total="COALESCE(group_n, 0)")} AS p,
    {_SHARE.format(n="k.n", total="lang_n")} AS q
  FROM grp g JOIN lang_of l ON g.lang = l.lang JOIN kept k ON k.lang = g.lang
  LEFT JOIN own w ON w.lang = g.lang AND w.source = g.source
  LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
prices AS (
  SELECT a.lang, a.source, b.source AS item, SUM(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
parts AS (
  SELECT g.lang, g.source, 'pair' AS part, h.source AS item, COALESCE(value, 0) AS value
  FROM grp g JOIN grp h ON g.lang = h.lang AND g.source <> h.source
  LEFT JOIN prices p ON p.lang = g.lang AND p.source = g.source AND p.item = h.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM shares WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM parts)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10
"""
