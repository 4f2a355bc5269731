"""Registered queries of the llm operators and their DuckDB texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import collocations, decontam, exact_dedup, langid, license, lm, mixing, quality, search, simhash, suffix_dedup, toxicity, urlfilter
from .common import LOWER, UPPER, crc_mod


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_read(spark, sf_dir, "documents"), k=3, budget=3)


# Fixed values of the contract: verdict, host, path prefix.
URL_RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
# Labels of spam sites: the canonical URLs of their pages are the listed ones.
SPAM_SITES = ("casino-win", "cheap-pills", "free-bets")
SPAM_HOST = f"(^|[.])({'|'.join(SPAM_SITES)})[.]"


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _read(spark, sf_dir, "pages")
    listed = urlfilter.canonical_urls(pages.where(urlfilter.host_of(F.col("url")).rlike(SPAM_HOST)))
    return urlfilter.judge(pages, listed, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_read(spark, sf_dir, "documents"), held_out=crc_mod("doc_id", 3) == 1, top=400)


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(_read(spark, sf_dir, "documents"), min_words=5, min_total=10, max_base=20, max_covered=0.2,
                          max_longest=100)


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each pair of a document and a benchmark item that overlap; clean documents have none."""
    return decontam.find_overlaps(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), min_tokens=13, min_identity=0.8)


def lm_role(id_col: str):
    """Remainder 0 of the id's crc32 is scored only, 1 sets the mixture weights, the rest are counted."""
    r = crc_mod(id_col, 10)
    return F.when(r == 0, lm.TEST).when(r == 1, lm.HELD).otherwise(lm.EST)


def op6_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.score(_read(spark, sf_dir, "documents"), lm_role("doc_id"))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), held_out=crc_mod("doc_id", 5) == 0,
                          toxic_docs=2000, clean_docs=4000, most_bytes=20_000)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.report(_read(spark, sf_dir, "documents"), weights=(1, 2, 3), most=3)


def op9_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license.scan(_read(spark, sf_dir, "documents"), min_share=0.5).withColumn("score", F.round("score", 6))


def op10_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.removal_report(_read(spark, sf_dir, "documents"), length=100)


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_read(spark, sf_dir, "documents"), max_words=3, least=10, top=2000, share=50)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.copies(_read(spark, sf_dir, "documents"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), top=10)


QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_url_filter": op2_url_filter,
    "op3_language": op3_language,
    "op4_quality": op4_quality,
    "op5_decontamination": op5_decontamination,
    "op6_lm": op6_lm,
    "op7_toxicity": op7_toxicity,
    "op8_mixing": op8_mixing,
    "op9_license": op9_license,
    "op10_suffix_array": op10_suffix_array,
    "op11_collocations": op11_collocations,
    "op12_exact_dedup": op12_exact_dedup,
    "op13_search": op13_search,
}


def _url_sql() -> str:
    rules = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in URL_RULES)
    return f"""
WITH u AS (
  SELECT row_number() OVER () AS rid, page_id, url,
         coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), '{UPPER}', '{LOWER}'), '') AS host,
         coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
c AS (SELECT *, regexp_replace(host, '^(www|m)[.]', '') || regexp_replace(path, '(/|[.]html)$', '') AS canon FROM u),
listed AS (SELECT DISTINCT canon FROM c WHERE url IS NOT NULL AND regexp_matches(host, '{SPAM_HOST}')),
rules(verdict, rhost, rpath) AS (VALUES {rules}),
best AS (
  SELECT rid, rhost || rpath AS rule, r.verdict FROM u JOIN rules r
    ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
  QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) = 1)
SELECT c.page_id, c.host, c.path, b.rule,
       coalesce(b.verdict, CASE WHEN l.canon IS NOT NULL THEN 'block' ELSE 'allow' END) AS verdict
FROM c LEFT JOIN best b USING (rid) LEFT JOIN listed l ON c.url IS NOT NULL AND l.canon = c.canon"""


def _license_sql() -> str:
    base = [(license.split_words(p), label) for p, label in license.BASE]
    templates = [(label, license.split_words(t), license.split_words(p)) for label, t, p in license.TEMPLATES]
    vocab = sorted({w for p, _ in base for w in p} | {w for _, t, _ in templates for w in t})
    lst = lambda ws: "[" + ", ".join(f"'{w}'" for w in ws) + "]"
    phrases = ", ".join(f"({k}, 'b', '{label}', {lst(p)}, 0)" for k, (p, label) in enumerate(base))
    for k, (label, t, p) in enumerate(templates):
        at = next(i for i in range(len(t)) if t[i:i + len(p)] == p)
        phrases += f", ({k}, 't', '{label}', {lst(p)}, {at})"
    words = ", ".join(f"({k}, {i}, '{w}')" for k, (_, t, _) in enumerate(templates) for i, w in enumerate(t))
    return f"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w
  FROM documents),
df AS (SELECT x, count(*) AS c FROM (SELECT DISTINCT rid, unnest(list_intersect(w, {lst(vocab)})) AS x FROM d) GROUP BY x),
idf AS (SELECT v.x, ln(((SELECT count(*) FROM d) + 1)::DOUBLE / (coalesce(df.c, 0) + 1)) + 1e-6 AS idf
        FROM (SELECT unnest({lst(vocab)}) AS x) v LEFT JOIN df USING (x)),
phrases(k, kind, label, p, shift) AS (VALUES {phrases}),
words(k, pos, x) AS (VALUES {words}),
places AS (
  SELECT rid, k, kind, label, shift, unnest(list_filter(range(len(w)), lambda i: list_slice(w, i + 1, i + len(p)) = p)) AS place
  FROM d JOIN phrases ON list_contains(w, p[1])),
match AS (
  SELECT m.rid, m.label, sum(CASE WHEN m.place - m.shift + t.pos >= 0 AND d.w[m.place - m.shift + t.pos + 1] = t.x THEN idf.idf ELSE 0 END) / sum(idf.idf) AS share
  FROM places m JOIN words t ON m.kind = 't' AND t.k = m.k JOIN idf ON idf.x = t.x JOIN d ON d.rid = m.rid
  GROUP BY m.rid, m.k, m.label, m.place),
b AS (SELECT rid, count(*) AS n, min(place) AS lo, max(place) AS hi, list(DISTINCT label) AS own FROM places WHERE kind = 'b' GROUP BY rid),
t AS (SELECT rid, max(share) AS top, list(DISTINCT label) AS more FROM match WHERE share >= 0.5 GROUP BY rid)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(b.n, 0) AS n_base, b.lo AS first_word, b.hi AS last_word,
       array_to_string(list_sort(coalesce(b.own, [])), ',') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.own, []), coalesce(t.more, [])))), ',') AS labels,
       round(least(coalesce(t.top, 0.0), 1.0), 6) AS score
FROM d LEFT JOIN b USING (rid) LEFT JOIN t USING (rid)"""


def _collocations_sql() -> str:
    return f"""
WITH w AS (
  SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w
  FROM (SELECT coalesce(lang, 'und') AS lang,
               unnest(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\\x0A-\\x0D]')) AS piece
        FROM documents)),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
f AS (SELECT lang, p, count(*) AS f
      FROM (SELECT lang, unnest(list_transform(range(1, len(w) - k + 2), lambda i: list_slice(w, i, i + k - 1))) AS p
            FROM w, (VALUES (1), (2), (3)) AS lengths(k) WHERE len(w) >= k)
      GROUP BY lang, p),
cand AS (SELECT lang, p, f AS a FROM f WHERE len(p) > 1 AND f >= 10),
cuts AS (
  SELECT c.lang, c.p, c.a, x.f AS l, y.f AS r, k, 1000000::HUGEINT * c.a * c.a // (x.f::HUGEINT * y.f) AS score
  FROM cand c CROSS JOIN (VALUES (1), (2)) AS ks(k)
  JOIN f x ON x.lang = c.lang AND x.p = list_slice(c.p, 1, k)
  JOIN f y ON y.lang = c.lang AND y.p = list_slice(c.p, k + 1, len(c.p))
  WHERE k < len(c.p)
  QUALIFY row_number() OVER (PARTITION BY c.lang, c.p ORDER BY score, k) = 1),
inside AS (
  SELECT lang, p, max(a) AS a
  FROM (SELECT lang, unnest([list_slice(p, 1, 2), list_slice(p, 2, 3)]) AS p, a FROM cand WHERE len(p) = 3)
  GROUP BY lang, p),
ranked AS (
  SELECT c.lang, array_to_string(c.p, ' ') AS phrase, c.a, c.l, c.r, CAST(c.score AS BIGINT) AS score,
         row_number() OVER (PARTITION BY c.lang ORDER BY c.score DESC, c.a DESC, array_to_string(c.p, ' ')) AS rank
  FROM cuts c LEFT JOIN inside i ON i.lang = c.lang AND i.p = c.p
  WHERE i.a IS NULL OR 100 * i.a < 50 * c.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN sizes USING (lang) WHERE rank <= 2000"""


def _exact_dedup_sql() -> str:
    return """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, first_value(doc_id) OVER g AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       row_number() OVER g = 1 AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t ORDER BY doc_id NULLS LAST, rid)"""


def _search_sql() -> str:
    words = f"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
    return f"""
WITH d AS (SELECT * FROM (SELECT row_number() OVER () AS rid, doc_id, {words} AS w FROM documents) WHERE len(w) > 0),
s AS (SELECT count(*) AS n_docs, CAST(sum(len(w)) AS HUGEINT) AS n_terms FROM d),
q AS (SELECT iid, item_id, x, count(*) AS k
      FROM (SELECT iid, item_id, unnest(w) AS x FROM (SELECT row_number() OVER () AS iid, item_id, {words} AS w FROM benchmark))
      GROUP BY ALL),
t AS (SELECT rid, x, count(*) AS tf FROM (SELECT rid, unnest(w) AS x FROM d) WHERE x IN (SELECT x FROM q) GROUP BY rid, x),
wt AS (SELECT x, CAST(floor(1000 * ln((2 * any_value(n_docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS weight FROM t, s GROUP BY x),
m AS (SELECT rid, doc_id, CAST(25 + (75::HUGEINT * len(w) * n_docs) // n_terms AS BIGINT) AS m FROM d, s),
scored AS (
  SELECT iid, item_id, doc_id, rid, CAST(sum(k * weight * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM q JOIN t USING (x) JOIN wt USING (x) JOIN m USING (rid) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST, rid) AS INTEGER) AS rank, doc_id, score
FROM scored WHERE score > 0 QUALIFY rank <= 10"""


ORACLE_SQL: dict[str, str] = {
    "op2_url_filter": _url_sql(),
    "op9_license": _license_sql(),
    "op11_collocations": _collocations_sql(),
    "op12_exact_dedup": _exact_dedup_sql(),
    "op13_search": _search_sql(),
}
