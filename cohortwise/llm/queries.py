"""The registered queries of the text operators, with their SQL twins where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from cohortwise.llm import (collocations, conversation_trie, divergence_rules, language_crf, minimax_shards, pivot_topk, quality_qda, sentencepiece_viterbi,
                            simhash_tiles, token_shards, url_rules, warc_chunks, wu_manber)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _register(name: str, sql: str | None = None):
    def put(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn
    return put


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_register("op1_elias_fano_token_shards")
def token_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_shards.written_digests(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@_register("op2_crf_language")
def languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_crf.identify(_table(spark, sf_dir, "documents"))


_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((CAST('0x' || substr(sha, {5 * g + 1}, 5) AS INTEGER) >> {s}) & 31) + 1, 1)"
    for g in range(8) for s in (15, 10, 5, 0))


@_register("op3_warc_chunks", f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS sha FROM pages),
f AS (SELECT *, min(page_id) OVER (PARTITION BY sha) AS first_id FROM p)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
 CASE WHEN page_id IS NOT DISTINCT FROM first_id THEN 'response' ELSE 'revisit' END AS record_type,
 CASE WHEN page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f""")
def warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_chunks.written_records(_table(spark, sf_dir, "pages"))


@_register("op4_quadratic_discriminant")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_qda.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@_register("op5_minimax_shards")
def shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minimax_shards.place(_table(spark, sf_dir, "documents"))


# Fixed values: reference languages and common words.
_COMMON = """the of and to in is that it for was de la le et les des un que est pour der die und den von zu das mit ist nicht
 el en y los las por con""".split()
_QUOTED = ", ".join(f"'{w}'" for w in _COMMON)
_SPELLED = ", ".join(f"'{v}'" for w in _COMMON for v in (w, w[0].upper() + w[1:]))
_PART = "CASE WHEN {0} > 0 THEN {0} * log2({0} / (({0} + {1}) / 2)) ELSE 0 END"
_TERM = f"({_PART.format('p', 'q')} + {_PART.format('q', 'p')}) / 2"


@_register("op6_divergence_rules", rf"""
WITH s AS (SELECT doc_id, lang, coalesce(text, '') AS t,
  list_filter(string_split_regex(coalesce(text, ''), '[ \t-\r]+'), lambda x: x <> '') AS w FROM documents),
d AS (SELECT row_number() OVER () AS r, *, CAST(len(w) AS BIGINT) AS n_words, length(array_to_string(w, '')) AS word_chars,
  len(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]'))) AS n_lines,
  len(list_distinct(list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^ \t-\r]')))) AS n_own_lines,
  regexp_replace(t, '[a-z \t-\r]+', '', 'g') AS rest FROM s),
win AS (SELECT r, p, array_to_string(w[p:p + 7], ' ') AS x FROM (SELECT r, w, unnest(range(1, len(w) - 6)) AS p FROM d WHERE len(w) >= 8) y),
rep AS (SELECT r, count(DISTINCT q) AS n FROM (SELECT r, unnest(range(p, p + 8)) AS q FROM (SELECT *, count(*) OVER (PARTITION BY r, x) AS c FROM win) z WHERE c > 1) u GROUP BY r),
c AS (SELECT d.*, coalesce(rep.n, 0) AS n_repeat_words, length(t) - word_chars AS space, length(rest) AS nr, regexp_replace(rest, '[A-Z]+', '', 'g') AS nu,
  list_filter(w, lambda x: x IN ({_SPELLED})) AS common FROM d LEFT JOIN rep ON d.r = rep.r),
h AS (SELECT *, length(nu) AS nn, length(regexp_replace(nu, '[^#*$%&|<>]+', '', 'g')) AS n_symbols, length(regexp_replace(nu, '[^0-9]+', '', 'g')) AS digits,
  length(regexp_replace(nu, '[\x00-\x7F]+', '', 'g')) AS beyond,
  n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM c),
f AS (SELECT *, [length(t) - space - nr, nr - nn, digits, space, beyond, nn - digits - beyond - n_symbols, n_symbols] AS ch,
  list_concat(list_transform([{_QUOTED}], lambda v: len(list_filter(common, lambda x: lower(x) = v))), [n_words - len(common)]) AS wd FROM h),
parts AS (SELECT r, lang, base_failed, n_words, 'c' AS kind, unnest(range(1, 8)) AS k, unnest(ch) AS v FROM f
  UNION ALL SELECT r, lang, base_failed, n_words, 'w', unnest(range(1, {len(_COMMON) + 2})), unnest(wd) FROM f),
refs AS (SELECT lang AS ref, kind, k, sum(v) * 1.0 / sum(sum(v)) OVER (PARTITION BY lang, kind) AS q FROM parts
  WHERE NOT base_failed AND lang IS NOT NULL GROUP BY lang, kind, k),
shares AS (SELECT *, v * 1.0 / greatest(sum(v) OVER (PARTITION BY r, kind), 1) AS p FROM parts WHERE n_words >= 50),
js AS (SELECT r, ref, shares.kind, sqrt(greatest(sum({_TERM}), 0)) AS j FROM shares JOIN refs ON shares.kind = refs.kind AND shares.k = refs.k
  AND (ref IN ('en', 'fr', 'de', 'es') OR ref = shares.lang) GROUP BY r, ref, shares.kind),
both_ AS (SELECT r, ref, max(CASE WHEN kind = 'c' THEN j END) AS c, max(CASE WHEN kind = 'w' THEN j END) AS w FROM js GROUP BY r, ref),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY c + w, c, w, ref) AS place FROM both_) x WHERE place = 1)
SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_lines - n_own_lines AS BIGINT) AS n_dup_lines,
 CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
 NOT base_failed AND coalesce(c <= 0.30 AND (best.w <= 0.295 OR n_words < 100 OR coalesce(lang NOT IN ('en', 'fr', 'de', 'es'), false)), true) AS kept,
 ref AS nearest_language, round(c, 6) AS character_distance, round(best.w, 6) AS word_distance
FROM f LEFT JOIN best ON f.r = best.r""")
def rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence_rules.report(_table(spark, sf_dir, "documents"))


@_register("op7_simhash_tiles")
def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_tiles.near_duplicates(_table(spark, sf_dir, "documents"))


@_register("op8_rarest_token_rules", r"""
WITH u AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, lower(coalesce(url, '')) AS low,
  translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path FROM u),
r AS (SELECT *, CASE
  WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
  WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
  WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule,
  CASE WHEN regexp_matches(low, '(?:^|[^a-z0-9])casino[-.]') THEN 'casino'
   WHEN regexp_matches(low, '://(?:[^/?#]*[.-])?(?:free|live)-bets[.-]') THEN 'bets'
   WHEN regexp_matches(low, '://(?:[^/?#]*[.-])?poker[.-]') THEN 'poker'
   WHEN regexp_matches(low, '://(?:[^/?#]*[.-])?(?:cheap|buy|online)-pills[.-]') THEN 'pills'
   WHEN regexp_matches(low, '[^a-z0-9]viagra[^a-z0-9]') THEN 'viagra'
   WHEN regexp_matches(low, '://(?:[^/?#]*\.)?xxx[.-]') THEN 'xxx'
   WHEN regexp_matches(low, '://(?:[^/?#]*[.-])?adult-[a-z]+\.') THEN 'adult'
   WHEN regexp_matches(low, '[^a-z0-9]porn[^a-z0-9]') THEN 'porn'
   WHEN regexp_matches(low, '://(?:[^/?#]*[.-])?(?:payday|fast|easy)-loans[.-]') THEN 'loans'
   WHEN regexp_matches(low, '://(?:[^/?#]*[.-])?spam-[a-z]+[.-]') THEN 'spam'
   WHEN regexp_matches(low, '://(?:[^/?#]*[.-])?ads-track[.-]') THEN 'tracking'
   WHEN regexp_matches(low, '://(?:[^/?#]*[.-])?(?:login|verify)-account[.-]') THEN 'phishing' END AS pattern
  FROM p)
SELECT page_id, host, path, rule,
 CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow' WHEN pattern IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
 CASE WHEN rule IS NULL THEN pattern END AS pattern_rule
FROM r""")
def urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_rules.judge(_table(spark, sf_dir, "pages"))


@_register("op9_wu_manber", r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, size, array_to_string(w[p:p + size - 1], ' ') AS s
       FROM (SELECT item_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM (SELECT item_id, w, least(10, len(w)) AS size FROM b WHERE len(w) > 0) x) y),
dw AS (SELECT doc_id, size, p, array_to_string(w[p:p + size - 1], ' ') AS s
       FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS p FROM d, (SELECT DISTINCT size FROM bw) z WHERE len(w) >= size) x),
m AS (SELECT doc_id, p, dw.size, item_id FROM dw JOIN bw ON dw.size = bw.size AND dw.s = bw.s),
h AS (SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM m) x GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n, string_agg(t, ',' ORDER BY t) AS t FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS t FROM m WHERE item_id IS NOT NULL) x GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(h.n, 0) AS n_hit, coalesce(i.n, 0) AS n_items,
 sha256(coalesce(i.t, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM d LEFT JOIN h ON d.doc_id = h.doc_id LEFT JOIN i ON d.doc_id = i.doc_id""")
def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wu_manber.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


@_register("op10_streaming_viterbi")
def pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_viterbi.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


# CRC-32 of decimal digits, bit by bit.
_CRC32 = """xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


@_register("op11_zfast_conversation_trie", f"""
WITH own AS (SELECT conv_id, list({{'role': coalesce(role, ''), 'text': coalesce("text", '')}} ORDER BY turn NULLS FIRST) AS s FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT *, {_CRC32} % 9 AS h FROM own),
r AS (SELECT o.conv_id, list_concat(coalesce(b.s[1:o.h], []), o.s[o.h + 1:]) AS s FROM h o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
p AS (SELECT conv_id, d, s[1:d] AS k, d = len(s) AS ended, CASE WHEN d > 0 THEN strlen(s[d].text) ELSE 0 END AS b FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM r) x),
g AS (SELECT k, d, min(conv_id) AS conv_id, count(*) AS n, min(b) AS b, coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), '') AS e FROM p GROUP BY k, d),
c AS (SELECT k[1:d - 1] AS k, d - 1 AS d, count(*) AS n_children FROM g WHERE d > 0 GROUP BY 1, 2),
f AS (SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN c ON g.d = c.d AND g.k = c.k),
u AS (SELECT k[1:x] AS k, x AS d, CAST(sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum((n - 1) * b) AS BIGINT) AS saved_tokens
      FROM (SELECT *, unnest(range(0, d + 1)) AS x FROM f) y GROUP BY 1, 2)
SELECT f.conv_id, f.d AS depth, up.conv_id AS parent_conv_id, f.n AS n_convs, f.n_children, u.n_leaves, u.saved_tokens, sha256(f.e) AS ends_sha256
FROM f JOIN u ON f.d = u.d AND f.k = u.k LEFT JOIN f up ON f.d > 0 AND up.d = f.d - 1 AND up.k = f.k[1:f.d - 1]""")
def conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.nodes(_table(spark, sf_dir, "conversations"))


@_register("op12_pivot_distance_topk", """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score FROM s
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id) QUALIFY row_number() OVER w <= 5""")
def nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivot_topk.search(_table(spark, sf_dir, "embeddings")).select("query_id", "rank", "vec_id", "score")


@_register("op13_best_first_collocations", r"""
WITH pc AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?
-]')) AS t FROM documents),
w AS (SELECT lang, list_filter(string_split_regex(t, '[ 	]+'), lambda x: x <> '') AS w FROM pc),
g AS (SELECT lang, m, array_to_string(w[p:p + m - 1], ' ') AS phrase FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS p FROM w, (SELECT unnest(range(1, 6)) AS m) x WHERE len(w) >= m) y),
f AS (SELECT lang, phrase, m, count(*) AS a FROM g GROUP BY lang, phrase, m HAVING count(*) >= 100),
n AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
sub AS (SELECT DISTINCT lang, array_to_string(s[i:i + j - 1], ' ') AS phrase, a FROM (SELECT lang, a, m, s, i, unnest(range(2, m)) AS j FROM
  (SELECT lang, a, m, string_split(phrase, ' ') AS s, unnest(range(1, m)) AS i FROM f WHERE m > 2) x) y WHERE i + j - 1 <= m),
cut AS (SELECT f.lang, f.phrase, f.a, n, k, l.a AS l, r.a AS r, CAST((CAST(1000 AS HUGEINT) * f.a * n) // (CAST(l.a AS HUGEINT) * r.a) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, m)) AS k FROM f WHERE m > 1 AND NOT EXISTS (SELECT 1 FROM sub WHERE sub.lang = f.lang AND sub.phrase = f.phrase AND sub.a >= f.a)) f
  JOIN n ON f.lang = n.lang JOIN f l ON l.lang = f.lang AND l.phrase = array_to_string(string_split(f.phrase, ' ')[1:k], ' ')
  JOIN f r ON r.lang = f.lang AND r.phrase = array_to_string(string_split(f.phrase, ' ')[k + 1:], ' ')),
low AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM low
QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000""")
def phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = collocations.mine(_table(spark, sf_dir, "documents"))
    return out.withColumn("rank", out["rank"].cast("long"))
