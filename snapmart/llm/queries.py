"""One registered query per corpus operator, each over its whole table, with DuckDB SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    ann,
    bpe,
    packing,
    positional_index,
    prefix_trie,
    quality_pu,
    quality_rules,
    ranked_search,
    secret_scan,
    sharding,
    shared,
    simhash,
    token_counts,
    toxicity,
)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every whole text: the base spans and those found by guess cost."""
    return secret_scan.scan(shared.read_table(spark, sf_dir, "documents"))


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every whole text before and after its cleaning edits."""
    docs = shared.read_table(spark, sf_dir, "documents")
    return token_counts.count_edited(docs, shared.vocabulary("byte_bpe_50k.json"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into sequences of at most 2048 tokens."""
    docs = shared.read_table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, shared.vocabulary("word_bpe_49k.json"), capacity=2048)


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every whole text with the byte-level vocabulary."""
    docs = shared.read_table(spark, sf_dir, "documents")
    return bpe.encode_decode(docs, shared.vocabulary("byte_bpe_50k.json")).drop("round_trip")


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents into 40 shards whose row counts differ by one at most."""
    out = sharding.assign(shared.read_table(spark, sf_dir, "documents"), shards=40)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


def op6_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 nearest by inner product of every vector whose id is divisible by 20."""
    return ann.search(shared.read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, top=20)


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every whole text by its compression distance to toxic and to ordinary text."""
    docs = shared.read_table(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.train(docs, shared.read_table(spark, sf_dir, "labels")))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document: 3-word shingles, links at 2 or fewer bits."""
    docs = shared.read_table(spark, sf_dir, "documents").select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return simhash.near_duplicates(docs, words=3, seed=42, threshold=2)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule ledger of every whole text with the verdict of policy v2."""
    book = quality_rules.ledger(shared.read_table(spark, sf_dir, "documents"))
    base = F.col("failed").bitwiseAND(F.lit(quality_rules.mask(quality_rules.BASE)).cast("bigint")) != 0
    return book.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       base.alias("base_failed"), quality_rules.passes("v2").alias("kept"), "failed")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score every whole text by the positive-unlabelled quality model."""
    found = shared.cut(quality_pu.measured(shared.read_table(spark, sf_dir, "documents")))
    return quality_pu.scored(found, quality_pu.fit(found, shared.read_table(spark, sf_dir, "labels")))


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every whole text that lie in an exact 10-word passage of a benchmark item, and the items found."""
    return positional_index.contamination(shared.read_table(spark, sf_dir, "documents"), shared.read_table(spark, sf_dir, "benchmark"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 best of all documents for every benchmark item."""
    return ranked_search.search(shared.read_table(spark, sf_dir, "documents"), shared.read_table(spark, sf_dir, "benchmark"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every node of the prefix trie of all rebuilt conversations."""
    return prefix_trie.trie(shared.read_table(spark, sf_dir, "conversations"))


REGISTRY: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_token_counts": op2_token_counts,
    "op3_packing": op3_packing,
    "op4_bpe": op4_bpe,
    "op5_sharding": op5_sharding,
    "op6_ann": op6_ann,
    "op7_toxicity": op7_toxicity,
    "op8_simhash": op8_simhash,
    "op9_quality_rules": op9_quality_rules,
    "op10_quality": op10_quality,
    "op11_decontamination": op11_decontamination,
    "op12_ranked_search": op12_ranked_search,
    "op13_prefix_trie": op13_prefix_trie,
}

SQL: dict[str, str] = {
    "op9_quality_rules": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents
), s AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM d
), grams AS (
  SELECT rid, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS g
  FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM s WHERE len(w) >= 3)
), twice AS (
  SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1
), covered AS (
  SELECT rid, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY rid
), m AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(c.n, 0)::BIGINT AS n_repeat_words,
         len(list_filter(w, lambda x: regexp_matches(x, '[A-Z]') AND NOT regexp_matches(x, '[a-z]')))::BIGINT AS n_upper_words,
         (length(t) - length(replace(t, '!', '')))::BIGINT AS n_bangs
  FROM s LEFT JOIN covered c USING (rid)
), f AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 10 * n_symbols > n_words THEN 4 ELSE 0 END + CASE WHEN 2 * n_dup_lines > n_lines THEN 8 ELSE 0 END
    + CASE WHEN n_words > 0 AND (word_chars < 3 * n_words OR word_chars > 14 * n_words) THEN 16 ELSE 0 END
    + CASE WHEN 10 * n_upper_words > 3 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 5 * n_bangs > n_words THEN 64 ELSE 0 END)::BIGINT AS failed
  FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed % 4 <> 0 AS base_failed,
       failed = 0 AS kept, failed
FROM f""",
    "op11_decontamination": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT row_number() OVER () AS iid, coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item, array_to_string(list_slice(w, a, a + 9), ' ') AS g, least(len(w), 10) AS n
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS a FROM b WHERE len(w) > 0)
), grams AS (
  SELECT rid, a, n, array_to_string(list_slice(w, a, a + n - 1), ' ') AS g
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS a FROM d, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
), hits AS (
  SELECT DISTINCT rid, a, n, item FROM grams JOIN windows USING (g, n)
), covered AS (
  SELECT rid, count(DISTINCT p) AS n FROM (SELECT rid, unnest(range(a, a + n)) AS p FROM hits) GROUP BY rid
), found AS (
  SELECT rid, count(*) AS n, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT rid, item FROM hits) GROUP BY rid
), words AS (
  SELECT rid, unnest(w) AS term, unnest(range(len(w))) AS p FROM d
), rarity AS (
  SELECT iid, item, 2 * len(w) AS reach, term, coalesce(n, 0) AS n, row_number() OVER (PARTITION BY iid ORDER BY coalesce(n, 0), term) AS k,
         count(*) OVER (PARTITION BY iid) AS n_terms
  FROM (SELECT DISTINCT iid, item, w, unnest(w) AS term FROM b) LEFT JOIN (SELECT term, count(*) AS n FROM words GROUP BY term) USING (term)
), anchors AS (
  SELECT iid, item, reach, n_terms, rid, p FROM rarity JOIN words USING (term) WHERE k = 1
), lists AS (
  SELECT rid, term, list(p) AS ps FROM words GROUP BY rid, term
), near AS (
  SELECT rid, count(DISTINCT item) AS n FROM (
    SELECT rid, iid, item, a.p FROM anchors a JOIN rarity r USING (iid, item, reach, n_terms) JOIN lists l USING (rid, term)
    WHERE len(list_filter(ps, lambda x: x BETWEEN a.p - reach AND a.p + reach)) > 0
    GROUP BY rid, iid, item, a.p, n_terms HAVING count(*) = n_terms)
  GROUP BY rid
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(covered.n, 0)::BIGINT AS n_hit, coalesce(found.n, 0)::BIGINT AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, covered.n IS NOT NULL AS contaminated, coalesce(near.n, 0)::BIGINT AS n_near_items
FROM d LEFT JOIN covered USING (rid) LEFT JOIN found USING (rid) LEFT JOIN near USING (rid)""",
    "op12_ranked_search": r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), b AS (
  SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), asked AS (
  SELECT iid, item_id, term, count(*) AS times FROM (
    SELECT iid, item_id, translate(unnest(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM b)
  GROUP BY ALL
), tf AS (
  SELECT rid, doc_id, size, term, count(*) AS tf FROM (
    SELECT rid, doc_id, len(w) AS size, translate(unnest(w), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM d)
  GROUP BY ALL
), df AS (
  SELECT term, count(*) AS df FROM tf GROUP BY term
), corpus AS (
  SELECT count(*) FILTER (WHERE len(w) > 0) AS docs, sum(len(w))::BIGINT AS length FROM d
), scored AS (
  SELECT iid, item_id, rid, doc_id, sum(times * floor(1000 * ln((2 * docs + 2) / (2 * df + 1)))::BIGINT
           * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * size * docs) // length))))::BIGINT AS score
  FROM asked JOIN tf USING (term) JOIN df USING (term), corpus
  GROUP BY iid, item_id, rid, doc_id
)
SELECT item_id, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10""",
    "op13_prefix_trie": r"""
WITH t AS (
  SELECT conv_id, length(role) || ':' || role || text AS s, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) AS n,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS p
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
), own AS (
  SELECT conv_id, list(s ORDER BY p) AS v, list(n ORDER BY p) AS w FROM t GROUP BY conv_id
), hashed AS (
  SELECT conv_id, v, w, xor(list_reduce(
    list_prepend(4294967295, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
    lambda c, x: list_reduce([xor(c, x), 0, 0, 0, 0, 0, 0, 0, 0],
                             lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END)), 4294967295) % 4 AS h
  FROM own
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(list_slice(b.v, 1, h), []), list_slice(c.v, h + 1, len(c.v))) AS v,
         list_concat(coalesce(list_slice(b.w, 1, h), []), list_slice(c.w, h + 1, len(c.w))) AS w
  FROM hashed c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 20
), prefixes AS (
  SELECT conv_id, d, list_slice(v, 1, d) AS k, len(v) = d AS whole, CASE WHEN d > 0 THEN w[d] ELSE 0 END AS words
  FROM (SELECT conv_id, v, w, unnest(range(len(v) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE whole), '')) AS ends
  FROM prefixes GROUP BY k, d
), children AS (
  SELECT list_slice(k, 1, d - 1) AS k, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1
), full_nodes AS (
  SELECT nodes.*, coalesce(n, 0) AS n_children FROM nodes LEFT JOIN children USING (k)
), tops AS (
  SELECT list_slice(k, 1, a) AS k, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum((n_convs - 1) * words) AS saved
  FROM (SELECT *, unnest(range(d + 1)) AS a FROM full_nodes) GROUP BY 1
)
SELECT f.conv_id, f.d::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, f.ends AS ends_sha256
FROM full_nodes f JOIN tops USING (k) LEFT JOIN nodes p ON f.d > 0 AND p.k = list_slice(f.k, 1, f.d - 1)""",
}
