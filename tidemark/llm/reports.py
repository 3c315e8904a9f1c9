"""Queries of this subpackage over the test tables, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, fill_middle, mixing, mtree, pii, prefix_trie, quality, repeats, simhash, slots, style_tree, token_counts, toxicity
from .common import small_batches

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")


def query(fn):
    @wraps(fn)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        small_batches(spark)
        return fn(spark, sf_dir)

    QUERIES[fn.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged, _ = quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", *names, "base_failed", "kept", "rejected_by")


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_texts(table(spark, sf_dir, "documents"), VOCABULARY, ids=False)


@query
def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents")).drop("fp")


@query
def op4_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "source", *[c for c in mixed.columns if c.startswith("mix_")])


@query
def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_private(table(spark, sf_dir, "documents"))
    counts = [f"n_{kind}" for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


@query
def op6_m_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"))


@query
def op7_slot_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return slots.shard_by_bytes(table(spark, sf_dir, "documents"))


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.rate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op9_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.repeated_strings(table(spark, sf_dir, "documents"))


@query
def op10_site_style_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return style_tree.main_texts(table(spark, sf_dir, "pages"))


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_VOCABULARY)


@query
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_nodes(table(spark, sf_dir, "conversations"))


@query
def op13_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fill_middle.restore(fill_middle.fill_middle(table(spark, sf_dir, "documents")))
    digests = [F.sha2(c, 256).alias(f"{c}_sha256") for c in ("output", "restored")]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


ORACLES["op6_m_tree"] = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), scored AS (
    SELECT q.vec_id AS query_id, c.vec_id,
           CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id
), ranked AS (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5
"""

ORACLES["op9_suffix_array"] = """
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, hex(coalesce(text, '')) AS x FROM documents
), strings AS (
    SELECT r, doc_id, i, substr(x, 2 * i + 1, 100) AS s
    FROM (SELECT r, doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS i FROM docs WHERE length(x) >= 100)
), hits AS (
    SELECT r, i FROM (SELECT r, i, doc_id, min(doc_id) OVER (PARTITION BY s) AS least FROM strings) WHERE least < doc_id
), runs AS (
    SELECT r, i, sum(fresh) OVER (PARTITION BY r ORDER BY i) AS g
    FROM (SELECT r, i, CASE WHEN i <= lag(i) OVER (PARTITION BY r ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM hits)
), spans AS (
    SELECT r, min(i) AS a, max(i) + 50 AS b FROM runs GROUP BY r, g
), pieces AS (
    SELECT r, a, b, coalesce(lag(b) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM spans
), cut AS (
    SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last,
           string_agg(substr(x, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS head
    FROM pieces JOIN docs USING (r) GROUP BY r
)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(CASE WHEN cut.r IS NULL THEN x ELSE head || substr(x, 2 * last + 1) END)) AS kept_sha256
FROM docs LEFT JOIN cut USING (r)
"""

ORACLES["op1_quality_rules"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t, coalesce('=' || lang, 'null') AS stratum FROM documents
), words AS (
    SELECT r, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i
    FROM (SELECT r, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws FROM docs)
), windows AS (
    SELECT r, i, word || ' ' || lead(word) OVER (PARTITION BY r ORDER BY i) || ' ' || lead(word, 2) OVER (PARTITION BY r ORDER BY i) AS g
    FROM words
), twice AS (
    SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM windows WHERE g IS NOT NULL) WHERE n > 1
), repeated AS (
    SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY r
), word_counts AS (
    SELECT r, count(*) AS n_words, sum(length(word)) AS word_chars FROM words GROUP BY r
), lines AS (
    SELECT r, row_number() OVER (PARTITION BY r, line) AS nth FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM docs)
    WHERE regexp_matches(line, '[^\x20\x09-\x0D]')
), line_counts AS (
    SELECT r, count(*) AS n_lines, count(*) FILTER (WHERE nth > 1) AS n_dup_lines FROM lines GROUP BY r
), counts AS (
    SELECT r, doc_id, stratum, coalesce(n_words, 0) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
           CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
           coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines,
           length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS n_letters
    FROM docs LEFT JOIN word_counts USING (r) LEFT JOIN line_counts USING (r) LEFT JOIN repeated USING (r)
), judged AS (
    SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
), values_of AS (
    SELECT r, stratum, base_failed, doc_id, unnest(['capitals', 'lines', 'repeats', 'symbols']) AS rule,
           unnest([n_upper / greatest(n_letters, 1), n_dup_lines / greatest(n_lines, 1), n_repeat_words / greatest(n_words, 1),
                   n_symbols / greatest(word_chars, 1)]) AS value
    FROM judged
), cells AS (
    SELECT * EXCLUDE (value), CAST(least(floor(value * 1000), 1000) AS INTEGER) AS place FROM values_of
), marks AS (
    SELECT doc_id, max(quality) = 1 AS good FROM labels WHERE doc_id IS NOT NULL AND quality IS NOT NULL GROUP BY doc_id
), trials AS (
    SELECT r FROM (SELECT r, row_number() OVER (PARTITION BY doc_id ORDER BY places DESC, stratum DESC) AS nth FROM (
        SELECT r, doc_id, stratum, list(place ORDER BY rule) AS places FROM cells WHERE NOT base_failed AND doc_id IS NOT NULL GROUP BY ALL))
    WHERE nth = 1
), marked AS (
    SELECT cells.*, good, sha256(CAST(doc_id AS VARCHAR))[1] < '4' AS draws FROM cells JOIN trials USING (r) JOIN marks USING (doc_id)
), tally AS (
    SELECT stratum, rule, place, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE NOT good) AS b FROM marked WHERE draws GROUP BY ALL
), tails AS (
    SELECT stratum, rule, place, CAST(sum(g) OVER down + 1 AS DOUBLE) / CAST(sum(b) OVER down + 1 AS DOUBLE) AS odds
    FROM tally WINDOW down AS (PARTITION BY stratum, rule ORDER BY place DESC)
), path AS (
    SELECT * FROM (SELECT stratum, rule, place AS step, min(odds) OVER (PARTITION BY stratum, rule ORDER BY place) AS level FROM tails WHERE place >= 1)
    WHERE level < 1
), held AS (
    SELECT r, m.stratum, good, min(level) AS level
    FROM marked m LEFT JOIN path ON path.stratum = m.stratum AND path.rule = m.rule AND step <= place WHERE NOT draws GROUP BY ALL
), levels AS (
    SELECT stratum, level, count(*) FILTER (WHERE good) AS g, count(*) FILTER (WHERE NOT good) AS b FROM held GROUP BY ALL
), running AS (
    SELECT *, sum(g) OVER up AS k, sum(b) OVER up AS hits, sum(g) OVER (PARTITION BY stratum) AS n
    FROM levels WINDOW up AS (PARTITION BY stratum ORDER BY level NULLS LAST)
), tested AS (
    SELECT *, level IS NULL OR CASE WHEN k >= n THEN 1 ELSE list_sum(list_transform(range(0, CAST(k AS BIGINT) + 1), lambda j:
             exp(lgamma(n + 1) - lgamma(j + 1) - lgamma(n - j + 1) + j * ln(0.04) + (n - j) * ln(0.96)))) END
           > 0.05 / (SELECT count(DISTINCT stratum) FROM levels) AS fails
    FROM running
), allowed AS (
    SELECT *, bool_or(fails) OVER (PARTITION BY stratum ORDER BY level NULLS LAST) AS stopped FROM tested
), chosen AS (
    SELECT stratum, level AS most FROM allowed WHERE NOT stopped AND hits > k
    QUALIFY row_number() OVER (PARTITION BY stratum ORDER BY hits - k DESC, level) = 1
), cuts AS (
    SELECT stratum, rule, min(step) AS cut FROM path JOIN chosen USING (stratum) WHERE level <= most GROUP BY stratum, rule
), hit AS (
    SELECT r, string_agg(rule, ',' ORDER BY rule) AS rejected_by FROM cells JOIN cuts USING (stratum, rule) WHERE place >= cut GROUP BY r
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND rejected_by IS NULL AS kept, coalesce(rejected_by, '') AS rejected_by
FROM judged LEFT JOIN hit USING (r)
"""

ORACLES["op12_prefix_trie"] = """
WITH own AS (
    SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
    FROM conversations WHERE conv_id IS NOT NULL
), bytes_of AS (
    SELECT DISTINCT c, list_transform(string_split(CAST(c AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT)) AS b FROM own
), convs AS (
    SELECT c, c - c % 100 AS base, xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], b), lambda crc, x:
           list_reduce(list_concat([xor(crc, x)], [CAST(0 AS BIGINT), 0, 0, 0, 0, 0, 0, 0]), lambda a, z: xor(a >> 1, (a & 1) * 3988292384)))) % 6 AS h
    FROM bytes_of
), turns AS (
    SELECT convs.c, pos, 0 AS side, role, text FROM convs JOIN own ON own.c = base WHERE pos <= h
    UNION ALL SELECT convs.c, pos, 1, role, text FROM convs JOIN own ON own.c = convs.c WHERE pos > h
), placed AS (
    SELECT *, row_number() OVER (PARTITION BY c ORDER BY side, pos) AS depth FROM turns
), prefixes AS (
    SELECT c, depth, length(text) AS chars, list(sha256(length(role) || ':' || role || text)) OVER (PARTITION BY c ORDER BY depth) AS path FROM placed
    UNION ALL SELECT c, 0, 0, CAST([] AS VARCHAR[]) FROM convs
), marked AS (
    SELECT *, depth = max(depth) OVER (PARTITION BY c) AS ends FROM prefixes
), nodes AS (
    SELECT path, depth, min(c) AS conv_id, count(*) AS n_convs, any_value(chars) * (count(*) - 1) AS saved,
           CAST(count(*) = count(*) FILTER (WHERE ends) AS BIGINT) AS leaf,
           sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ends), '')) AS ends_sha256
    FROM marked GROUP BY path, depth
), reached AS (
    SELECT path[1:k] AS path, leaf, saved FROM (SELECT *, unnest(range(0, depth + 1)) AS k FROM nodes)
), totals AS (
    SELECT path, sum(leaf) AS n_leaves, sum(saved) AS saved_tokens FROM reached GROUP BY path
), children AS (
    SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, n.ends_sha256
FROM nodes n JOIN totals t ON t.path = n.path LEFT JOIN children c ON c.path = n.path LEFT JOIN nodes p ON p.path = n.path[1:n.depth - 1] AND n.depth > 0
"""

ORACLES["op13_fill_middle"] = """
WITH docs AS (
    SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS x FROM documents
), drawn AS (
    SELECT *, list_transform([1, 9, 17, 25], lambda i: CAST('0x' || substr(x, i, 8) AS BIGINT)) AS h FROM docs
), cut AS (
    SELECT *, least(h[1] % (n + 1), h[2] % (n + 1)) AS a, greatest(h[1] % (n + 1), h[2] % (n + 1)) AS b,
           CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h[3] % 100 >= 90 THEN 'plain'
                WHEN h[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
    FROM drawn
), parts AS (
    SELECT *, substr(t, 1, a) AS prefix, substr(t, a + 1, b - a) AS middle, substr(t, b + 1) AS suffix FROM cut
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || prefix || '<S>' || suffix || '<M>' || middle
                        ELSE '<S>' || suffix || '<P>' || prefix || '<M>' || middle END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
