"""The operators' queries over the given tables, and the SQL of those that
SQL can express."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import ensure_checkpoint_dir
from . import collocations, decontaminate, editprint, hmm, lattice, mixing, pieces, quality, repair, simhash, substring, tokencount, warc
from .common import table

PIECE_MODEL, BYTE_RANKS = "piece_bpe_32k.model", "byte_bpe_50k.tiktoken"


def tokenizer_file(name: str) -> bytes:
    """A public tokenizer's file; it is small, and goes to tasks with their code."""
    import public_tokenizers

    with open(public_tokenizers.path(name), "rb") as f:
        return f.read()


def op1_edit_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return editprint.edit_prints(table(spark, sf_dir, "documents"))


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op3_hmm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_texts(table(spark, sf_dir, "documents"))


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_vectors(table(spark, sf_dir, "embeddings"))


def op6_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring.remove_repeats(table(spark, sf_dir, "documents"))
    return out.select("doc_id", F.col("_n_words").alias("n_words"), F.col("_n_removed").alias("n_removed"), F.col("_kept_sha256").alias("kept_sha256"))


def op7_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), tokenizer_file(PIECE_MODEL))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix_sources(docs).drop("_rate").withColumnsRenamed({"_copy": "copy", "_order": "shuffle_order"})


def op9_section_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return tokencount.section_tokens(table(spark, sf_dir, "documents"), tokenizer_file(BYTE_RANKS), public_tokenizers.PATTERN)


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{ensure_checkpoint_dir(spark)}/warc-{uuid.uuid4().hex}"
    warc.write_archive(warc.plan_records(table(spark, sf_dir, "pages")), path)
    return warc.page_report(warc.read_archive(spark, path))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def op12_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return repair.repair(repair.damaged(conversations), every=conversations)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_edit_fingerprints, op2_simhash, op3_hmm_score, op4_quality, op5_lattice, op6_substring, op7_pieces, op8_mix, op9_section_tokens, op10_warc, op11_collocations, op12_decontaminate, op13_repair, pipeline)
}

ORACLE: dict[str, str] = {
    # links in double precision, and what they reach
    "op5_lattice": """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e,
         label IS NOT NULL AND embedding IS NOT NULL
           AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), false)
           AND coalesce(list_bool_or(list_transform(embedding, lambda x: x <> 0)), false) AS ok
  FROM embeddings),
l AS (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND a.ok AND b.ok
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93),
r AS (
  SELECT vec_id AS a, vec_id AS b FROM v
  UNION
  SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS component_id FROM r GROUP BY a),
n AS (SELECT a, count(*) AS n_links FROM l GROUP BY a)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN c ON c.a = vec_id LEFT JOIN n ON n.a = vec_id
""",
    "op6_substring": r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT doc_id, unnest(generate_series(1, len(ws) - 49)) AS s, ws FROM w WHERE len(ws) >= 50),
h AS (
  SELECT doc_id, s, md5(array_to_string(list_slice(ws, s, s + 49), ' ')) AS h FROM s),
f AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h),
g AS (
  SELECT DISTINCT h.doc_id, unnest(generate_series(s, s + 49)) AS i
  FROM h JOIN f USING (h) WHERE f.first < h.doc_id),
gone AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id),
k AS (
  SELECT doc_id, len(ws) AS n_words, coalesce(len(gone), 0) AS n_removed,
         CASE WHEN gone IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(gone, i)) END AS kept
  FROM w LEFT JOIN gone USING (doc_id))
SELECT doc_id, n_words::BIGINT AS n_words, n_removed::BIGINT AS n_removed,
       sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256
FROM k
""",
    # the distribution function of each source's rate by its terms
    "op8_mix": """
WITH RECURSIVE n AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
t AS (SELECT sum(n) AS rows, sum(pow(n::DOUBLE, 0.5)) AS weights FROM n),
r AS (SELECT source, pow(n::DOUBLE, 0.5) / weights * rows / n AS rate FROM n, t),
d AS (SELECT source, greatest(ceil(rate / 16.0), 1)::INT AS draws, rate / greatest(ceil(rate / 16.0), 1) AS each FROM r),
p AS (
  SELECT source, each, 0 AS k, exp(-each) AS p, exp(-each) AS s FROM d
  UNION ALL
  SELECT source, each, k + 1, p * each / (k + 1), s + p * each / (k + 1) FROM p WHERE k < 80),
u AS (
  SELECT doc_id, source, i,
         ('0x' || substr(md5('1:' || doc_id || ':' || i), 1, 13))::BIGINT / 4503599627370496.0 AS u
  FROM (SELECT doc_id, documents.source, unnest(generate_series(1, draws)) AS i
        FROM documents JOIN d ON documents.source IS NOT DISTINCT FROM d.source)),
c AS (
  SELECT doc_id, u.source, i, count(*) AS k
  FROM u JOIN p ON u.source IS NOT DISTINCT FROM p.source AND p.s <= u.u GROUP BY doc_id, u.source, i),
m AS (SELECT doc_id, sum(k) AS k FROM c GROUP BY doc_id),
e AS (SELECT doc_id, unnest(generate_series(1, k::INT)) AS copy FROM m)
SELECT documents.*, copy::INT AS copy,
       ('0x' || substr(md5('order:1:' || doc_id || ':' || copy), 1, 13))::BIGINT / 4503599627370496.0 AS shuffle_order
FROM e JOIN documents USING (doc_id)
""",
    "op10_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS d, strlen(coalesce(html, ''))::BIGINT AS n FROM pages),
l AS (SELECT d, max(page_id) AS last FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to
FROM p LEFT JOIN l ON l.d = p.d AND p.n >= 1000
""",
    # counts of all phrases of up to five words
    "op11_collocations": r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
n AS (SELECT lang, sum(len(ws)) AS n FROM w GROUP BY lang),
s AS (
  SELECT lang, ws, k, unnest(generate_series(1, len(ws) - k + 1)) AS i
  FROM w, (SELECT unnest(generate_series(1, 5)) AS k) WHERE len(ws) >= k),
f AS (
  SELECT lang, k, phrase, count(*) AS a
  FROM (SELECT lang, k, array_to_string(list_slice(ws, i, i + k - 1), ' ') AS phrase FROM s)
  GROUP BY lang, k, phrase HAVING count(*) >= 100),
c AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS ws FROM f WHERE k > 1),
cuts AS (SELECT lang, k, phrase, a, ws, unnest(generate_series(1, k - 1)) AS cut FROM c),
scored AS (
  SELECT cuts.lang, cuts.phrase, cuts.a, cut, x.a AS l, y.a AS r, n.n,
         (1000::HUGEINT * cuts.a::HUGEINT * n.n::HUGEINT) // (x.a::HUGEINT * y.a::HUGEINT) AS score
  FROM cuts JOIN n ON n.lang = cuts.lang
  JOIN f AS x ON x.lang = cuts.lang AND x.phrase = array_to_string(list_slice(ws, 1, cut), ' ')
  JOIN f AS y ON y.lang = cuts.lang AND y.phrase = array_to_string(list_slice(ws, cut + 1, cuts.k), ' ')),
lowest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
parts AS (SELECT lang, ws, a, k, m, unnest(generate_series(1, k - m + 1)) AS i FROM c, (SELECT unnest(generate_series(2, 4)) AS m) WHERE m < k),
inside AS (SELECT lang, array_to_string(list_slice(ws, i, i + m - 1), ' ') AS phrase, max(a) AS around FROM parts GROUP BY ALL),
kept AS (SELECT lowest.* FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE around IS NULL OR 100 * around < 100 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n::BIGINT AS n, score::BIGINT AS score FROM ranked WHERE rank <= 2000
""",
    # every window of an item's words, wherever a document has it
    "op12_decontaminate": r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
b AS (
  SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
i AS (SELECT item_id, ws, least(len(ws), 10) AS n FROM b WHERE len(ws) > 0),
s AS (SELECT item_id, n, ws, unnest(generate_series(1, len(ws) - n + 1)) AS first_word FROM i),
g AS (SELECT DISTINCT item_id, n, array_to_string(list_slice(ws, first_word, first_word + n - 1), ' ') AS gram FROM s),
lengths AS (SELECT DISTINCT n FROM g),
p AS (SELECT doc_id, ws, n, unnest(generate_series(1, len(ws) - n + 1)) AS first_word FROM d, lengths WHERE len(ws) >= n),
w AS (SELECT doc_id, n, first_word, array_to_string(list_slice(ws, first_word, first_word + n - 1), ' ') AS gram FROM p),
h AS (SELECT doc_id, first_word, w.n, item_id FROM w JOIN g ON w.n = g.n AND w.gram = g.gram),
c AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(generate_series(first_word, first_word + n - 1)) AS word FROM h) GROUP BY doc_id),
k AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS items FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON c.doc_id = d.doc_id LEFT JOIN k ON k.doc_id = d.doc_id
""",
}
