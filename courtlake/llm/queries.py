"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courtlake.llm import byte_bpe, centroids, decontaminate, html_extract, ngram_join, packing, quality, ranked_search, sharding, substring
from courtlake.llm import token_counts, toxicity, url_filter

QUERIES = {}
ORACLES = {}

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _query(f):
    QUERIES[f.__name__] = f
    return f


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@_query
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """4-word shingles, Jaccard at least 0.85: size of each document's set and its component."""
    return ngram_join.link_components(_table(spark, sf_dir, "documents"), size=4, percent=85)


ORACLES["op8_ngram_jaccard_join"] = f"""
WITH RECURSIVE
d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [list_aggregate(w, 'string_agg', ' ')]
        ELSE list_transform(range(1, len(w) - 2), lambda i: list_aggregate(w[i:i + 3], 'string_agg', ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
r(x, y) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, min(r.y) AS component_id
FROM d LEFT JOIN n USING (doc_id) JOIN r ON r.x = d.doc_id GROUP BY d.doc_id
"""


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@_query
def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 2048 tokens."""
    return packing.pack(_table(spark, sf_dir, "documents"), _tokenizer("word_bpe_49k.json"), capacity=2048, end_id=0)


@_query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of at least 50 words that an earlier document holds too, at a 5-word shingle similarity of 0.8."""
    return substring.repeated_passages(_table(spark, sf_dir, "documents"), min_words=50, percent=80)


@_query
def op4_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside occurrences of 10-word windows of benchmark items."""
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), window=10)


_WORDS4 = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
ORACLES["op4_benchmark_decontamination"] = f"""
WITH
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS4} AS w FROM benchmark),
win AS (SELECT DISTINCT item, list_aggregate(x, 'string_agg', ' ') AS k, len(x) AS n FROM (
    SELECT item, unnest(list_transform(range(1, greatest(len(w) - 9, 1) + 1), lambda i: w[i:i + 9])) AS x FROM b WHERE len(w) > 0)),
d AS (SELECT doc_id, {_WORDS4} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM win),
p AS (SELECT doc_id, n, unnest(range(1, len(w) - n + 2)) AS i, w FROM d, sizes WHERE len(w) >= n),
m AS (SELECT doc_id, i, p.n, item FROM p JOIN win ON win.k = list_aggregate(w[i:i + p.n - 1], 'string_agg', ' ') AND win.n = p.n),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM m GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
    sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@_query
def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 40 shards of equal counts."""
    return sharding.shard_rows(_table(spark, sf_dir, "documents"), shards=40)


#: Fixed values of the query's contract: host, path, verdict.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


@_query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict of four rules on every page's url."""
    rules = spark.createDataFrame(RULES, "host string, path string, verdict string")
    return url_filter.judge_urls(_table(spark, sf_dir, "pages").select("page_id", "url"), rules)


_FITS = "(host = '{0}' OR ends_with(host, '.{0}')) AND starts_with(path, '{1}')"
_CASES = [(_FITS.format(h, p), h + p, v) for h, p, v in sorted(RULES, key=lambda r: (-r[0].count("."), -len(r[1])))]
ORACLES["op3_url_filters"] = f"""
WITH u AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
v AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{_UPPER}', '{_LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM u)
SELECT page_id, host, path, CASE {' '.join(f"WHEN {c} THEN '{r}'" for c, r, _ in _CASES)} END AS rule,
    CASE {' '.join(f"WHEN {c} THEN '{v}'" for c, _, v in _CASES)} ELSE 'allow' END AS verdict
FROM v
"""


@_query
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severity of every document, from a model fitted to the labels."""
    documents = _table(spark, sf_dir, "documents")
    model = toxicity.fit(documents, toxicity.label_grades(_table(spark, sf_dir, "labels")))
    return toxicity.severity(documents, model)


@_query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and the log-likelihood ratio of documents labelled good against all."""
    documents = _table(spark, sf_dir, "documents")
    good = _table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return quality.judge(documents, quality.fit_ratio(documents, good))


@_query
def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_extract.extract(_table(spark, sf_dir, "pages"))


@_query
def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every line of every document; a token that crosses lines counts where it starts."""
    import public_tokenizers

    return token_counts.section_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, rule="start")


@_query
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """40 clusters of all vectors after five rounds."""
    return centroids.cluster(_table(spark, sf_dir, "embeddings"), k=40, rounds=5)


def _clustering_sql(k: int, rounds: int) -> str:
    parts = [f"""v AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
    WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, x AS y FROM v ORDER BY sha256('2:' || vec_id) LIMIT {k})"""]
    near = """SELECT vec_id, x, arg_min(c, (d, c)) AS c, min(d) AS d FROM (
    SELECT vec_id, x, c, list_sum(list_transform(list_zip(x, y), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, {0}) GROUP BY vec_id, x"""
    for r in range(rounds):
        parts.append(f"a{r} AS MATERIALIZED ({near.format(f'c{r}')})")
        parts.append(f"""m{r} AS (SELECT c, list(z ORDER BY i) AS y FROM (SELECT c, i, (s - ((s % n) + n) % n) // n AS z FROM (
    SELECT c, i, CAST(sum(e) AS BIGINT) AS s, count(*) AS n FROM (SELECT c, unnest(x) AS e, generate_subscripts(x, 1) AS i FROM a{r}) GROUP BY c, i)) GROUP BY c)""")
        parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c, coalesce(m.y, o.y) AS y FROM c{r} o LEFT JOIN m{r} m USING (c))")
    parts.append(f"a{rounds} AS MATERIALIZED ({near.format(f'c{rounds}')})")
    return f"""WITH {', '.join(parts)}
SELECT vec_id, CAST(c AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY c) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia,
    sha256(array_to_string(y, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} USING (c)"""


ORACLES["op11_centroid_clustering"] = _clustering_sql(40, 5)


@_query
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 documents of highest score for every benchmark item."""
    return ranked_search.rank(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"), k=20)


_TERMS12 = f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
ORACLES["op12_ranked_search"] = f"""
WITH d AS (SELECT doc_id, {_TERMS12} AS w FROM documents),
s AS (SELECT count(*) AS big_n, CAST(sum(len(w)) AS BIGINT) AS big_l FROM d WHERE len(w) > 0),
t AS (SELECT doc_id, term, count(*) AS tf, any_value(n) AS n FROM (SELECT doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY doc_id, term),
f AS (SELECT term, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM t, s GROUP BY term, big_n),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, unnest({_TERMS12}) AS term FROM benchmark) GROUP BY ALL),
x AS (SELECT item_id, doc_id, CAST(sum(times * weight * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * big_n) // big_l)))) AS BIGINT) AS score
    FROM q JOIN f USING (term) JOIN t USING (term), s GROUP BY item_id, doc_id),
r AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM x WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 20
"""


@_query
def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the ranks of a multilingual vocabulary, and what they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(_table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
    return byte_bpe.digests(encoded, byte_bpe.read_ranks(path))
