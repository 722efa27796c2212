"""The registered queries of this subpackage, and their SQL where there is any."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessella.llm import (
    conversation_repair,
    divergence,
    embedding_dedup,
    exact_dedup,
    language_id,
    license_scan,
    mixing,
    ngram_join,
    packing,
    pii,
    quality,
    suffix_dedup,
    toxicity,
)

QUERIES: dict = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@query
def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of every document, in the order of the first training position."""
    plan = mixing.plan_mix(documents(spark, sf_dir))
    return plan.select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (F.col("size") * F.col("epochs")).alias("taken"),
        "first_position",
    ).orderBy("first_position", "doc_id")


ORACLE["op3_curriculum_mix"] = r"""
WITH d AS (
  SELECT doc_id, source, md5('mix:' || doc_id) AS rank,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), r AS (
  SELECT source, source_size, source_size * 3 AS cap,
    (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS slot,
    CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
      WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
  FROM s
), w AS (
  SELECT *, row_number() OVER o AS place,
    (sum(source_size) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
      )::BIGINT AS rest,
    sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights
  FROM r WINDOW o AS (ORDER BY cap / weight, source NULLS LAST)
), f AS (
  SELECT place AS first_open, rest AS open_rest, weights AS open_weights FROM w
  WHERE cap > rest / weights * weight ORDER BY place LIMIT 1
), t AS (
  SELECT source, source_size, slot,
    CASE WHEN place >= first_open THEN open_rest::DOUBLE * weight / open_weights ELSE cap::DOUBLE END AS target
  FROM w LEFT JOIN f ON true
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.slot,
    coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY d.rank, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT + d.size / 2 AS middle
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
), e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END AS whole,
    least(middle / greatest(target, 1.0::DOUBLE), 1.0::DOUBLE) AS share
  FROM p
)
SELECT doc_id, size, source_size, target,
  (size * least(3, whole + CASE WHEN size > 0 AND middle <= target - whole * source_size THEN 1 ELSE 0 END))::BIGINT
    AS taken,
  CASE slot
    WHEN 0 THEN least(1.0::DOUBLE, share * 2 / (1.5 + sqrt(2.25 + share * -2.0)))
    WHEN 1 THEN least(1.0::DOUBLE, share * 2 / (0.5 + sqrt(0.25 + share * 2.0)))
    ELSE least(1.0::DOUBLE, share * 2 / (1.0 + sqrt(1.0 + share * 0.0))) END AS first_position
FROM e
"""


@query
def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every chunk of every document with its bin."""
    return packing.best_fit_packing(documents(spark, sf_dir))


@query
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id stays."""
    return exact_dedup.exact_dedup(documents(spark, sf_dir))


ORACLE["op10_exact_dedup"] = """
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = max(doc_id) OVER g AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW g AS (PARTITION BY coalesce(text, ''))
"""


@query
def op5_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 5-word shingle sets are 80 % alike."""
    return ngram_join.ngram_join(documents(spark, sf_dir))


ORACLE["op5_ngram_join"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5
    THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS x
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i
  FROM s a JOIN s b ON a.x = b.x AND a.doc_id <> b.doc_id GROUP BY ALL
), e AS (
  SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 80 * (na.n + nb.n - i)
), r(doc_id, c) AS (
  SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, e.b FROM r JOIN e ON r.c = e.a
)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.c) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN r USING (doc_id) GROUP BY d.doc_id
"""


@query
def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without the 50-byte strings of earlier documents."""
    spans = suffix_dedup.repeated_spans(documents(spark, sf_dir))
    return spans.select(
        "doc_id",
        "n_bytes",
        F.aggregate("removed", F.lit(0).cast("long"), lambda n, x: n + x["end"] - x["start"]).alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        "kept_sha256",
    )


@query
def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and templates in every text."""
    return license_scan.scan_licenses(documents(spark, sf_dir)).drop("spans")


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every text, learned from three of four documents."""
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_id.train(docs.where(~held_out))
    return language_id.identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query
def op4_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of personal data in every text."""
    docs = documents(spark, sf_dir)
    found = pii.find_private(docs, pii.train(docs))
    base = F.filter("spans", lambda s: s["base"])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined("spans").alias("spans"))


@query
def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links between vectors of a cosine of 0.95 or more, and their components."""
    return embedding_dedup.near_duplicates(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


ORACLE["op6_embedding_dedup"] = """
WITH RECURSIVE v AS (
  SELECT vec_id, embedding::DOUBLE[] AS x FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
    ON a.vec_id <> b.vec_id AND len(a.x) = len(b.x) AND list_cosine_similarity(a.x, b.x) >= 0.95
), r(vec_id, c) AS (
  SELECT vec_id, vec_id FROM embeddings UNION SELECT r.vec_id, l.b FROM r JOIN l ON r.c = l.a
), n AS (
  SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a
)
SELECT e.vec_id, coalesce(any_value(n.n), 0)::BIGINT AS n_links, min(r.c) AS component_id,
  e.vec_id = min(r.c) AS kept
FROM embeddings e JOIN r USING (vec_id) LEFT JOIN n USING (vec_id) GROUP BY e.vec_id
"""


@query
def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality of every document, learned from the labelled ones."""
    docs = documents(spark, sf_dir)
    model = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.score_quality(docs, model)


@query
def op11_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far every source of a language lies from the others and from the language."""
    return divergence.divergence_audit(documents(spark, sf_dir))


ORACLE["op11_divergence_audit"] = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents
), g AS (
  SELECT DISTINCT lang, source FROM d
), k AS (
  SELECT lang, term FROM (SELECT lang, unnest(list_distinct(t)) AS term FROM d) GROUP BY ALL HAVING count(*) >= 30
), v AS (
  SELECT l.lang, count(k.term) AS V FROM (SELECT DISTINCT lang FROM g) l LEFT JOIN k USING (lang) GROUP BY l.lang
), c AS (
  SELECT o.lang, o.source, o.term, count(*) AS cnt
  FROM (SELECT lang, source, unnest(t) AS term FROM d) o JOIN k USING (lang, term) GROUP BY ALL
), x AS (
  SELECT g.lang, g.source, k.term, coalesce(c.cnt, 0) AS cnt
  FROM g JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)
), n AS (
  SELECT g.lang, g.source, coalesce(sum(c.cnt), 0) AS N FROM g LEFT JOIN c USING (lang, source) GROUP BY ALL
), p AS (
  SELECT x.*, 1 + (1000000000::HUGEINT * (cnt + 5)) // (n.N + 5 * v.V) AS p
  FROM x JOIN n USING (lang, source) JOIN v USING (lang)
), q AS (
  SELECT x.lang, x.term, 1 + (1000000000::HUGEINT * (sum(x.cnt) + 5)) // (any_value(l.NL) + 5 * any_value(v.V)) AS q
  FROM x JOIN (SELECT lang, sum(N) AS NL FROM n GROUP BY lang) l USING (lang) JOIN v USING (lang) GROUP BY ALL
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), r AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
  UNION ALL
  SELECT p.lang, p.source, 'term', p.term, p.p - q.q FROM p JOIN q USING (lang, term) WHERE p.cnt > 0 AND p.p > q.q
), s AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank FROM r
)
SELECT lang, source, part, item, value::BIGINT AS value, rank::INTEGER AS rank FROM s WHERE part = 'pair' OR rank <= 50
"""


@query
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every whole text, learned from four of five labelled documents."""
    docs = documents(spark, sf_dir)
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), held_out)
    scored = toxicity.score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted", "lang_guess")


@query
def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults and the cheapest repair of every damaged conversation (no SQL: tested against exhaustive search)."""
    return conversation_repair.repair(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
