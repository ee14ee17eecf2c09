"""The operators of this folder as queries over whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costalloc.llm import chat, decontam, extract, mixing, mixture, negatives, packing, quality, simhash, substrings, trie, urls, warc
from costalloc.llm.common import ship, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return rated.drop("trusted")


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.score(table(spark, sf_dir, "documents"), block_bytes=8 << 20, below=True)


def op3_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), coverage=0.5, least=5)


URL_RULES = [
    urls.HostRule(urls.ALLOW, "org", "/"),
    urls.HostRule(urls.BLOCK, "example.org", "/es/"),
    urls.HostRule(urls.BLOCK, "example.org", "/en/1"),
    urls.HostRule(urls.ALLOW, "com", "/fr/"),
    urls.HostRule(urls.BLOCK, "com", "/de/"),
]


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, labels = table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels")
    return urls.judge(pages, labels, URL_RULES, min_support=0.0005, min_count=5, min_confidence=0.7)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.remove_repeats(table(spark, sf_dir, "documents"), size=13, digest=True)


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)


def op7_warc_packages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"), min_bytes=0)


def op8_hilbert_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), sequence=2048, with_ids=False)


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.collapse_and_render(table(spark, sf_dir, "conversations"))


def op10_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract.extract(table(spark, sf_dir, "pages"))


def op11_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixture.rated(table(spark, sf_dir, "documents"), most=3)
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return rows.select("row.doc_id", "size", "source_size", "target", taken)


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.prefix_tree(table(spark, sf_dir, "conversations"), group=20, heads=4)


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return negatives.hard_negatives(negatives.shifted_labels(table(spark, sf_dir, "embeddings")))


def _shipped(query: Query) -> Query:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


OPERATORS = [
    op1_quality_rules,
    op2_lm_scoring,
    op3_benchmark_decontamination,
    op4_url_filters,
    op5_substring_dedup,
    op6_simhash_near_dedup,
    op7_warc_packages,
    op8_hilbert_packing,
    op9_chat_formatting,
    op10_html_extraction,
    op11_source_mixing,
    op12_conversation_trie,
    op13_hard_negatives,
]
QUERIES: dict[str, Query] = {f.__name__: _shipped(f) for f in OPERATORS}
ORACLES: dict[str, str] = {
    "op5_substring_dedup": r"""
WITH d AS (
    SELECT doc_id, [w FOR w IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> ''] AS words FROM documents),
w AS (SELECT doc_id, unnest(words) AS word, unnest(range(1, len(words) + 1)) AS place FROM d),
runs AS (SELECT doc_id, i, array_to_string(words[i : i + 12], ' ') AS run
    FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM d)),
first AS (SELECT run, min(doc_id) AS first_id FROM runs GROUP BY run HAVING count(DISTINCT doc_id) > 1),
gone AS (SELECT DISTINCT doc_id, i + k AS place FROM runs JOIN first USING (run), range(0, 13) AS t(k) WHERE first_id < doc_id),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text FROM w ANTI JOIN gone USING (doc_id, place) GROUP BY doc_id)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(n, 0) AS BIGINT) AS n_removed,
    sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op7_warc_packages": """
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY digest) AS first_id FROM d),
groups AS (SELECT *, [CAST('0x' || substr(digest, 5 * i + 1, 5) AS BIGINT) FOR i IN range(0, 8)] AS bits FROM f)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
    list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((bits[k // 4 + 1] >> (15 - 5 * (k % 4))) & 31 AS BIGINT) + 1, 1)
        FOR k IN range(0, 32)], 'string_agg', '') AS payload_digest,
    CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id = first_id THEN NULL ELSE first_id END AS refers_to
FROM groups
""",
    "op9_chat_formatting": r"""
WITH t AS (
    SELECT DISTINCT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
    FROM conversations WHERE conv_id IS NOT NULL),
c AS (
    SELECT conv_id, count(*) AS n_turns, list(struct_pack(role, text) ORDER BY turn NULLS FIRST) AS turns,
        string_agg('<|im_start|>' || replace(replace(translate(role, chr(10), ' '), '<|im_start|>', '<\|im_start|>'), '<|im_end|>', '<\|im_end|>')
            || chr(10) || replace(replace(text, '<|im_start|>', '<\|im_start|>'), '<|im_end|>', '<\|im_end|>')
            || '<|im_end|>' || chr(10), '' ORDER BY turn NULLS FIRST) AS text
    FROM t GROUP BY conv_id),
prefixes AS (
    SELECT DISTINCT turns[1:k] AS turns FROM (SELECT turns, unnest(range(1, n_turns)) AS k FROM c)),
one AS (
    SELECT min(conv_id) AS conv_id, count(*) AS n_copies, any_value(n_turns) AS n_turns, any_value(text) AS text, turns
    FROM c GROUP BY turns)
SELECT conv_id, n_turns, n_copies, text FROM one WHERE turns NOT IN (SELECT turns FROM prefixes)
""",
    # The level of words per weight: the first source, by bound per weight, that is not cut at its bound.
    "op11_source_mixing": r"""
WITH d AS (
    SELECT doc_id, source, text,
        CAST(len([w FOR w IN string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+') IF w <> '']) AS BIGINT) AS size
    FROM documents),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS place
    FROM d GROUP BY source),
w AS (SELECT *, CAST([5, 2, 1][CAST((place - 1) % 3 AS BIGINT) + 1] AS DOUBLE) AS weight, CAST(3 * source_size AS DOUBLE) AS bound FROM s),
c AS (
    SELECT *, (SELECT CAST(sum(source_size) AS DOUBLE) FROM s) AS total, bound / weight AS ratio,
        coalesce(sum(bound) OVER (ORDER BY bound / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
        sum(weight) OVER (ORDER BY bound / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS others
    FROM w),
level AS (
    SELECT (total - before) / others AS level FROM c WHERE bound >= (total - before) / others * weight
    ORDER BY ratio, place LIMIT 1),
t AS (SELECT source, source_size, least(bound, weight * level) AS target FROM c, level),
r AS (
    SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
        CAST('0x' || substr(md5('11:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 13) AS BIGINT)
            / 4503599627370496.0 AS chance
    FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
    size * CAST(floor(rate) + CASE WHEN chance < rate - floor(rate) THEN 1 ELSE 0 END AS BIGINT) AS taken
FROM r
""",
    "op12_conversation_trie": r"""
WITH turns AS (
    SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
    FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(struct_pack(role, text) ORDER BY place) AS turns FROM turns GROUP BY conv_id),
bits AS (  -- crc32 by the polynomial 0xEDB88320, a byte at a time
    SELECT conv_id, list_reduce(list_prepend(4294967295::BIGINT, [ascii(c)::BIGINT FOR c IN string_split(CAST(conv_id AS VARCHAR), '')]),
        lambda x, b: list_reduce(list_prepend(xor(x, b), [0::BIGINT FOR i IN range(8)]),
            lambda y, z: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384::BIGINT) ELSE y >> 1 END)) AS crc
    FROM own),
h AS (SELECT conv_id, xor(crc, 4294967295::BIGINT) % 4 AS h FROM bits),
built AS (
    SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1 : h.h], o.turns[h.h + 1 :]) AS turns
    FROM own o JOIN h USING (conv_id) LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
starts AS (SELECT conv_id, len(turns) AS n, unnest(range(0, len(turns) + 1)) AS depth, turns FROM built),
p AS (SELECT conv_id, n, depth, sha256(CAST(turns[1 : depth] AS VARCHAR)) AS node,
    CASE WHEN depth > 0 THEN sha256(CAST(turns[1 : depth - 1] AS VARCHAR)) END AS above,
    CASE WHEN depth > 0 THEN len([w FOR w IN string_split_regex(turns[depth].text, '[\x20\x09-\x0D]+') IF w <> '']) ELSE 0 END AS words
    FROM starts),
nodes AS (
    SELECT node, any_value(above) AS above, any_value(depth) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
        sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE n = depth), '')) AS ends_sha256
    FROM p GROUP BY node),
children AS (SELECT above AS node, count(*) AS n_children FROM nodes WHERE above IS NOT NULL GROUP BY above),
pairs AS (SELECT DISTINCT a.node AS top, b.node AS node FROM p a JOIN p b ON a.conv_id = b.conv_id AND a.depth <= b.depth),
sums AS (
    SELECT top AS node, count(*) FILTER (WHERE n_children IS NULL) AS n_leaves, CAST(sum((n_convs - 1) * words) AS BIGINT) AS saved_tokens
    FROM pairs JOIN nodes USING (node) LEFT JOIN children USING (node) GROUP BY top)
SELECT n.conv_id, n.depth, a.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, saved_tokens, n.ends_sha256
FROM nodes n LEFT JOIN nodes a ON n.above = a.node LEFT JOIN children c ON c.node = n.node JOIN sums s ON s.node = n.node
""",
    "op13_hard_negatives": """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
    SELECT anchor_id, id, score FROM s WHERE alike
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (
    SELECT anchor_id, p.id AS positive_id, s.id AS negative_id, p.score AS positive_score, s.score AS negative_score,
        CAST(row_number() OVER (PARTITION BY anchor_id, p.id ORDER BY s.score DESC, s.id) AS INTEGER) AS rank
    FROM p JOIN s USING (anchor_id) WHERE NOT alike AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 5
""",
    # Every subset of a labelled URL's tokens is counted, instead of only frequent ones.
    "op4_url_filters": r"""
WITH u AS (SELECT page_id, coalesce(url, '') AS url FROM pages),
x AS (SELECT DISTINCT url, '(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?' AS re FROM u),
y AS (
    SELECT url, translate(regexp_extract(url, re, 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS scheme,
        translate(regexp_extract(url, re, 2), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(url, re, 3) AS path, regexp_extract(url, re, 4)[2:] AS args
    FROM x),
p AS (
    SELECT url, host, path, list_distinct(
        ['s:' || v FOR v IN [scheme] IF v <> ''] || ['d:' || v FOR v IN [host] IF v <> '']
        || ['h:' || v FOR v IN string_split(host, '.') IF v <> ''] || ['p:' || v FOR v IN string_split(path, '/') IF v <> '']
        || ['q:' || v FOR v IN string_split(args, '&') IF v <> '']) AS tokens
    FROM y),
known AS (
    SELECT doc_id AS page_id, max(CASE WHEN quality = 0 OR toxic = 1 THEN 1 ELSE 0 END) AS bad
    FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
labelled AS (SELECT row_number() OVER () AS row, p.tokens, k.bad FROM u JOIN p USING (url) JOIN known k USING (page_id)),
least AS (SELECT greatest(5, ceil(count(*) * 0.0005)) AS least FROM labelled),
places AS (
    SELECT token, list(row ORDER BY row) AS rows
    FROM (SELECT row, bad, unnest(tokens) AS token FROM labelled) GROUP BY token
    HAVING sum(bad) >= (SELECT least FROM least)),
named AS (SELECT token, min(token) OVER (PARTITION BY rows) AS item FROM places),
items AS (
    SELECT row, bad, list(DISTINCT item) AS items
    FROM (SELECT row, bad, unnest(tokens) AS token FROM labelled) JOIN named USING (token) GROUP BY row, bad),
subsets AS (
    SELECT list_sort([items[i] FOR i IN range(1, len(items) + 1) IF (mask >> (i - 1)) & 1 = 1]) AS items, bad
    FROM (SELECT items, bad, unnest(range(1, CAST(pow(2, len(items)) AS BIGINT))) AS mask FROM items)),
sets AS (SELECT items, count(*) AS pages, CAST(sum(bad) AS BIGINT) AS bad FROM subsets GROUP BY items),
rules AS (
    SELECT items, pages, bad FROM sets
    WHERE bad >= (SELECT least FROM least) AND bad >= 0.7 * pages
        AND NOT (len([i FOR i IN items IF starts_with(i, 'd:')]) > 0 AND len([i FOR i IN items IF starts_with(i, 'h:')]) > 0)),
own AS (
    SELECT url, list(DISTINCT item) AS items
    FROM (SELECT url, unnest(tokens) AS token FROM p) JOIN named USING (token) GROUP BY url),
hits AS (
    SELECT url, array_to_string(rules.items, ' ') AS pattern,
        row_number() OVER (PARTITION BY url ORDER BY -bad / pages, -bad, array_to_string(rules.items, ' ')) AS n
    FROM own JOIN rules ON list_has_all(own.items, rules.items)),
given(verdict, host, path) AS (VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
fits AS (
    SELECT p.url, g.host || g.path AS rule, g.verdict,
        row_number() OVER (PARTITION BY p.url ORDER BY length(g.host || g.path) DESC) AS n
    FROM p JOIN given g ON (p.host = g.host OR ends_with(p.host, '.' || g.host)) AND starts_with(p.path, g.path))
SELECT u.page_id, p.host, p.path, f.rule,
    coalesce(f.verdict, CASE WHEN h.pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict, h.pattern
FROM u JOIN p USING (url) LEFT JOIN (SELECT * FROM fits WHERE n = 1) f USING (url)
LEFT JOIN (SELECT * FROM hits WHERE n = 1) h USING (url)
""",
}
