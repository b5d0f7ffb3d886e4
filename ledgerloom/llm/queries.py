"""The registered queries of this subpackage, with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from .centroids import clusters
from .decontaminate import contaminated
from .divergence import source_divergence
from .exact_dedup import exact_duplicates
from .language_id import languages
from .line_dedup import shared_line_dedup
from .mixing import Mix, mixed
from .ngram_jaccard import jaccard_components
from .sharding import sharded
from .simhash import simhash_components
from .storage import table
from .token_files import token_round_trip
from .toxicity import toxicity
from .url_filter import claimed_twice, judged_urls

RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]
SHARDS = 8
MIX = Mix(
    domains={"crawl": ["src0"], "books": [f"src{i}" for i in range(1, 10)]},
    domain_weights={"crawl": 3, "books": 5, "rest": 4},
    language_weights={"en": 6, "de": 2, "fr": 2, "es": 2},
    budget=(4, 5),
    max_epochs=2,
)


def vocabulary(name: str) -> str:
    """Path of a public tokenizer file; read on the driver only."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    result = shared_line_dedup(table(spark, sf_dir, "documents"))
    return result.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark passage, with the items; clean documents have no row."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixed(table(spark, sf_dir, "documents"), MIX)


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The list is of canonical URLs that more than one page claims."""
    pages = table(spark, sf_dir, "pages")
    return judged_urls(pages, claimed_twice(pages), RULES)


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharded(table(spark, sf_dir, "documents"), SHARDS)


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), end_id=2)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return languages(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_multi_50k.tiktoken"))


def op11_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(table(spark, sf_dir, "documents"))


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence(table(spark, sf_dir, "documents"))


def op13_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clusters(table(spark, sf_dir, "embeddings"))


QUERIES = {
    f.__name__: f
    for f in (
        op1_ngram_jaccard, op2_line_dedup, op3_exact_dedup, op4_decontaminate, op5_source_mix,
        op6_url_filter, op7_sharding, op8_token_files, op9_toxicity, op10_language_id,
        op11_simhash, op12_source_divergence, op13_centroid_clustering,
    )
}

_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_UPPER, _LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"


def _mix_sql(mix: Mix) -> str:
    def case(column: str, values: dict[str, int]) -> str:
        whens = " ".join(f"WHEN {column} = '{k}' THEN {v}" for k, v in values.items())
        return f"CASE {whens} ELSE {mix.other} END" if whens else str(mix.other)

    domain = " ".join(f"WHEN origin IN ({', '.join(repr(s) for s in v)}) THEN '{k}'" for k, v in mix.domains.items())

    def level(n: int, parent: str, name: str, values: dict[str, int], budgets: str) -> str:
        keys = f"{parent}, " if parent else ""
        by = f"PARTITION BY {parent}" if parent else ""
        join = f"JOIN {budgets} USING ({parent})" if parent else f", {budgets}"
        return f"""
nodes{n} AS (SELECT * , {case(name, values)} AS weight
  FROM (SELECT {keys}{name}, CAST(SUM(held) AS BIGINT) AS held FROM leaves GROUP BY {keys}{name}) AS n {join}),
ranked{n} AS (SELECT *, held * SUM(weight) OVER ({by} ORDER BY held / weight, {name} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
  <= weight * (budget - COALESCE(SUM(held) OVER ({by} ORDER BY held / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS is_full
  FROM nodes{n}),
given{n} AS (SELECT {keys}{name}, CAST(CASE WHEN is_full THEN held ELSE
  ((budget - COALESCE(SUM(CASE WHEN is_full THEN held END) OVER ({by}), 0)) * weight) // SUM(CASE WHEN NOT is_full THEN weight END) OVER ({by}) END AS BIGINT) AS budget
  FROM ranked{n})"""

    return f"""WITH docs AS (
SELECT *, CASE {domain} ELSE '{mix.rest}' END AS domain FROM (
  SELECT doc_id, COALESCE(lang, '(none)') AS language, COALESCE(source, '(none)') AS origin,
    CAST(len(regexp_extract_all(COALESCE(text, ''), '[^\\x20\\x09-\\x0D]+')) AS BIGINT) AS n_tokens FROM documents) AS d
WHERE n_tokens > 0),
leaves AS (SELECT domain, language, origin, CAST(SUM(n_tokens) AS BIGINT) AS tokens, CAST(SUM(n_tokens) * {mix.max_epochs} AS BIGINT) AS held
  FROM docs GROUP BY ALL),
given AS (SELECT CAST(SUM(tokens) * {mix.budget[0]} AS BIGINT) // {mix.budget[1]} AS budget FROM leaves),
{level(0, '', 'domain', mix.domain_weights, 'given')},
{level(1, 'domain', 'language', mix.language_weights, 'given0')},
{level(2, 'domain, language', 'origin', mix.source_weights, 'given1')},
due AS (SELECT docs.*, budget // tokens AS epochs, budget % tokens AS prefix
  FROM docs JOIN leaves USING (domain, language, origin) JOIN given2 USING (domain, language, origin)),
placed AS (SELECT *, COALESCE(SUM(n_tokens) OVER (PARTITION BY domain, language, origin
  ORDER BY md5('{mix.seed}:' || epochs || ':' || doc_id), doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM due)
SELECT doc_id, domain, language, origin, CAST(unnest(range(epochs)) AS BIGINT) AS epoch, n_tokens, n_tokens AS taken FROM due
UNION ALL
SELECT doc_id, domain, language, origin, CAST(epochs AS BIGINT), n_tokens, CAST(least(n_tokens, prefix - before) AS BIGINT) FROM placed WHERE before < prefix"""


def _clusters_sql(k: int, rounds: int) -> str:
    """Each round: every vector with its nearest centroid, then the floored means."""

    def nearest(n: int) -> str:
        return f"""near{n} AS MATERIALIZED (SELECT vec_id, v, min(struct_pack(d := CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT), number := number)) AS best
  FROM kept, centroids{n} GROUP BY vec_id, v)"""

    def means(n: int) -> str:
        return f"""sums{n} AS (SELECT number, i, SUM(x) AS s, COUNT(*) AS n FROM (SELECT best.number AS number, unnest(v) AS x, unnest(range(64)) AS i FROM near{n}) AS l GROUP BY number, i),
means{n} AS (SELECT number, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS c FROM sums{n} GROUP BY number),
centroids{n + 1} AS MATERIALIZED (SELECT number, COALESCE(m.c, o.c) AS c FROM centroids{n} AS o LEFT JOIN means{n} AS m USING (number))"""

    steps = ",\n".join(f"{nearest(n)},\n{means(n)}" for n in range(rounds))
    return f"""WITH kept AS MATERIALIZED (
SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
centroids0 AS MATERIALIZED (SELECT CAST(row_number() OVER (ORDER BY sha256('1:' || vec_id)) - 1 AS INTEGER) AS number, v AS c
  FROM kept ORDER BY sha256('1:' || vec_id) LIMIT {k}),
{steps},
{nearest(rounds)}
SELECT vec_id, best.number AS cluster, best.d AS distance, CAST(SUM(best.d) OVER (PARTITION BY best.number) AS BIGINT) AS cluster_inertia,
  CAST(SUM(best.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM near{rounds} JOIN centroids{rounds} ON number = best.number"""


# Eleven equal words of thirteen have a run of four, so an item and a document with a passage share four words in a row.
_WORDS4 = "SELECT {0}, unnest(range(1, len(w) - 2)) AS p, w FROM {1} WHERE len(w) >= {2}"

ORACLES = {
    "op1_ngram_jaccard": f"""WITH RECURSIVE words AS (
SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), {_UPPER}, {_LOWER}), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
  ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS s FROM words),
tokens AS (SELECT doc_id, unnest(s) AS t FROM sets),
common AS (SELECT x.doc_id AS a, y.doc_id AS b, COUNT(*) AS c FROM tokens x JOIN tokens y ON x.t = y.t AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM common JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b WHERE 100 * c >= 85 * (len(x.s) + len(y.s) - c)),
ties AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach(doc_id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.doc_id, ties.b FROM reach JOIN ties ON ties.a = reach.r)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, MIN(r) AS component_id FROM sets JOIN reach USING (doc_id) GROUP BY doc_id, s""",
    "op4_decontaminate": f"""WITH docs AS (
SELECT doc_id, regexp_extract_all(translate(COALESCE(text, ''), {_UPPER}, {_LOWER}), '[^\\x00-/:-`{{-\\x7f]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all(translate(COALESCE(text, ''), {_UPPER}, {_LOWER}), '[^\\x00-/:-`{{-\\x7f]+') AS w FROM benchmark),
places AS ({_WORDS4.format('doc_id', 'docs', 4)}),
item_places AS ({_WORDS4.format('item_id', 'items', 5)}),
runs AS (SELECT DISTINCT doc_id, item_id, places.p - item_places.p AS shift, places.w AS dw, item_places.w AS iw
  FROM places JOIN item_places ON places.w[places.p:places.p + 3] = item_places.w[item_places.p:item_places.p + 3]),
windows AS (SELECT doc_id, item_id, shift, dw, iw, least(13, len(iw)) AS size, unnest(range(1, len(iw) - least(13, len(iw)) + 2)) AS q FROM runs),
matched AS (SELECT doc_id, item_id, q + shift - 1 AS place, size,
  len(list_filter(range(0, size), lambda k: dw[q + shift + k] = iw[q + k])) AS equal
  FROM windows WHERE q + shift >= 1 AND q + shift + size - 1 <= len(dw))
SELECT doc_id, item_id, COUNT(DISTINCT place) AS n_windows, MAX(equal) AS best_equal, MIN(place) AS first_word
FROM matched WHERE equal >= CASE WHEN size < 13 THEN size ELSE 11 END GROUP BY doc_id, item_id""",
    "op2_line_dedup": f"""WITH lines AS (
SELECT doc_id, line, pos, translate(trim(line, {_BLANKS}), {_UPPER}, {_LOWER}) AS key
FROM (SELECT doc_id, unnest(string_split(COALESCE(text, ''), chr(10))) AS line,
  generate_subscripts(string_split(COALESCE(text, ''), chr(10)), 1) AS pos FROM documents) AS l),
shared AS (SELECT key, MAX(doc_id) AS top FROM lines WHERE length(key) >= 20 GROUP BY key HAVING COUNT(DISTINCT doc_id) >= 3),
marked AS (SELECT doc_id, line, pos, COALESCE(doc_id < top, FALSE) AS dropped FROM lines LEFT JOIN shared USING (key))
SELECT doc_id, COUNT(*) AS n_lines, COUNT(*) FILTER (dropped) AS n_dropped,
  sha256(COALESCE(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op3_exact_dedup": """SELECT doc_id, MAX(doc_id) OVER (PARTITION BY COALESCE(text, '')) AS keep_id,
  COUNT(*) OVER (PARTITION BY COALESCE(text, '')) AS group_size,
  doc_id = MAX(doc_id) OVER (PARTITION BY COALESCE(text, '')) AS kept, sha256(COALESCE(text, '')) AS text_sha256
FROM documents""",
    "op5_source_mix": _mix_sql(MIX),
    "op12_source_divergence": f"""WITH docs AS (
SELECT doc_id, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source,
  regexp_extract_all(translate(COALESCE(text, ''), {_UPPER}, {_LOWER}), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS w FROM documents),
words AS (SELECT doc_id, lang, source, unnest(w) AS term FROM docs),
kept AS (SELECT lang, term, COUNT(*) AS everywhere FROM words GROUP BY lang, term HAVING COUNT(DISTINCT doc_id) >= 30),
pools AS (SELECT DISTINCT lang, source FROM docs),
counted AS (SELECT lang, source, term, COUNT(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
cells AS (SELECT lang, source, term, COALESCE(n, 0) AS n, everywhere FROM pools JOIN kept USING (lang) LEFT JOIN counted USING (lang, source, term)),
shares AS (SELECT lang, source, term, n,
  1 + CAST(1000000000 * CAST(n + 5 AS HUGEINT) // (SUM(n) OVER (PARTITION BY lang, source) + 5 * COUNT(*) OVER (PARTITION BY lang, source)) AS BIGINT) AS p FROM cells),
whole AS (SELECT lang, term,
  1 + CAST(1000000000 * CAST(everywhere + 5 AS HUGEINT) // (SUM(everywhere) OVER (PARTITION BY lang) + 5 * COUNT(*) OVER (PARTITION BY lang)) AS BIGINT) AS q FROM kept),
far AS (SELECT x.lang, x.source, y.source AS item, CAST(SUM(abs(x.p - y.p)) AS BIGINT) AS value
  FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
found AS (SELECT x.lang, x.source, 'pair' AS part, y.source AS item, COALESCE(value, 0) AS value
  FROM pools x JOIN pools y ON x.lang = y.lang AND x.source <> y.source LEFT JOIN far ON far.lang = x.lang AND far.source = x.source AND far.item = y.source
  UNION ALL SELECT lang, source, 'term', term, p - q FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= 50""",
    "op13_centroid_clustering": _clusters_sql(16, 3),
    "op6_url_filter": f"""WITH cut AS (
SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT *, regexp_extract(rest, '^[^/?#]*') AS h FROM cut),
named AS (SELECT page_id, url, COALESCE(translate(h, {_UPPER}, {_LOWER}), '') AS host,
  COALESCE(regexp_extract(substr(rest, length(h) + 1), '^[^?#]*'), '') AS path FROM parts),
queries AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(url, '^[^?#]*\\?([^#]*)', 1), '&'),
  lambda x: x <> '' AND NOT regexp_matches(x, '^(utm_[a-z]+|ref|fbclid|gclid)='))) AS query FROM named),
canon AS (SELECT *, regexp_replace(host, '^(www|m)\\.', '') || regexp_replace(path, '/+$', '')
  || CASE WHEN len(query) > 0 THEN '?' || array_to_string(query, '&') ELSE '' END AS canonical FROM queries),
listed AS (SELECT canonical FROM canon WHERE canonical <> '' AND contains(canonical, '.') GROUP BY canonical HAVING COUNT(DISTINCT page_id) > 1),
ruled AS (SELECT *, host || '.' AS _, CASE
  WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
  WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
  WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
  WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM canon)
SELECT page_id, host, path, rule, CASE
  WHEN rule IN ('www.example.com/en/', 'com/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
  WHEN canonical IN (SELECT canonical FROM listed) THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""",
}
