"""The registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartmill.llm import (
    cotraining,
    line_dedup,
    quality_rules,
    scalar_tables,
    simhash_dedup,
    source_mix,
    span_dedup,
    token_files,
    token_streams,
    toxicity,
    url_filter,
    vector_codes,
    vector_tree,
)
from chartmill.llm.common import saved

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@_query
def op4_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return quality_rules.cascade(
        docs, measures=quality_rules.MEASURES, flags={"base_failed": quality_rules.BASE}, carry=["doc_id"]
    )


WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: Measures of every document, as a table expression named m.
MEASURES_SQL = rf"""
w AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS_SQL} AS words FROM documents),
v AS (SELECT doc_id, words, unnest(generate_series(1, len(words) - 2)) AS i FROM w),
g AS (SELECT doc_id, i, words[i:i + 2] AS g FROM v),
r AS (SELECT doc_id, i FROM g QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
p AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM r, (VALUES (0), (1), (2)) AS s(k) GROUP BY doc_id),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w),
d AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup FROM l
      WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
m AS (SELECT doc_id, text, len(words)::BIGINT AS n_words,
        length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
        length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
        coalesce(d.n_dup, 0)::BIGINT AS n_dup_lines, coalesce(p.n, 0)::BIGINT AS n_repeat_words,
        coalesce(d.n_lines, 0) AS n_lines
      FROM w LEFT JOIN p USING (doc_id) LEFT JOIN d USING (doc_id))
"""
REJECTED_SQL = r"""(10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
  OR 2 * length(regexp_replace(text, '[^\p{Lu}]', '', 'g')) > length(regexp_replace(text, '[^\p{L}]', '', 'g'))
  OR NOT word_chars BETWEEN 2 * n_words AND 15 * n_words)"""

SQL["op4_quality_rules"] = f"""
WITH {MEASURES_SQL},
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND NOT {REJECTED_SQL} AS kept
FROM b
"""


@_query
def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash_dedup.near_duplicates(_table(spark, folder, "documents"))


@_query
def op7_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    return token_streams.round_trip_digests(_table(spark, folder, "documents"), path)


@_query
def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return line_dedup.remove_repeated_lines(docs)


#: Documents after line deduplication, as table expressions over a table named src; the last is deduped.
LINE_DEDUP_SQL = r"""
sl AS (SELECT doc_id, string_split(text, chr(10)) AS lines FROM src),
wi AS (SELECT doc_id, lines, unnest(generate_series(1, len(lines) - 2)) AS i FROM sl),
wn AS (SELECT doc_id, i, lines[i] AS a, lines[i + 1] AS b, lines[i + 2] AS c FROM wi
       WHERE regexp_matches(concat(lines[i], lines[i + 1], lines[i + 2]), '[^\x20\x09-\x0D]')),
rp AS (SELECT doc_id, i FROM wn QUALIFY row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, i) > 1),
cv AS (SELECT DISTINCT doc_id, i + k AS i FROM rp, (VALUES (0), (1), (2)) AS s(k)),
al AS (SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS i FROM sl),
kp AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY i) AS text, count(*) AS n FROM al ANTI JOIN cv USING (doc_id, i)
       GROUP BY doc_id),
deduped AS (SELECT src.* REPLACE (CASE WHEN src.text IS NULL THEN NULL ELSE coalesce(kp.text, '') END AS text),
              coalesce(len(sl.lines), 0)::BIGINT AS n_lines,
              (coalesce(len(sl.lines), 0) - coalesce(kp.n, 0))::BIGINT AS n_removed
            FROM src JOIN sl USING (doc_id) LEFT JOIN kp USING (doc_id))
"""
SQL["op3_line_dedup"] = f"""
WITH src AS (SELECT * FROM documents), {LINE_DEDUP_SQL}
SELECT doc_id, text, n_lines, n_removed FROM deduped
"""


@_query
def op5_span_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return span_dedup.remove_repeated_spans(docs)


@_query
def op6_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text", "source")
    return source_mix.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


#: The mix of a table named src, as table expressions; the last is mixed.
MIX_SQL = rf"""
dz AS (SELECT *, len({WORDS_SQL})::BIGINT AS size, md5('mix:' || doc_id::VARCHAR) AS h FROM src),
so AS (SELECT source, sum(size)::BIGINT AS source_size,
         [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM dz GROUP BY source),
-- In the order in which sources reach their limit (of two epochs): those before the k-th are clamped.
rk AS (SELECT *, 4 * source_size AS cap, row_number() OVER (ORDER BY 4 * source_size / weight, source NULLS LAST) AS k,
         3 * sum(source_size) OVER () AS everything FROM so),
cu AS (SELECT *, everything - (sum(cap) OVER (ORDER BY k) - cap) AS room,
         sum(weight) OVER (ORDER BY k ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights FROM rk),
fx AS (SELECT k AS first_free, room, weights FROM cu WHERE cap * weights >= weight * room ORDER BY k LIMIT 1),
tg AS (SELECT rk.*, CASE WHEN first_free IS NULL OR k < first_free THEN source_size * 2.0::DOUBLE
         ELSE weight::DOUBLE * room::DOUBLE / (weights * 2)::DOUBLE END AS target FROM rk LEFT JOIN fx ON true),
ep AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM tg),
er AS (SELECT *, target - whole * source_size AS rest FROM ep),
st AS (SELECT dz.source, h, rest, sum(size) OVER (PARTITION BY dz.source ORDER BY h) AS after FROM dz
       JOIN er ON dz.source IS NOT DISTINCT FROM er.source WHERE rest > 0),
nr AS (SELECT source, h, abs(after - rest) AS off FROM st UNION ALL SELECT DISTINCT source, '', rest FROM st),
ct AS (SELECT source, min((off, h)) AS cut FROM nr GROUP BY source),
mixed AS (SELECT dz.*, er.source_size, er.target,
            er.whole + CASE WHEN dz.size > 0 AND dz.h <= ct.cut[2] THEN 1 ELSE 0 END AS copies
          FROM dz JOIN er ON dz.source IS NOT DISTINCT FROM er.source
          LEFT JOIN ct ON dz.source IS NOT DISTINCT FROM ct.source)
"""
SQL["op6_source_mix"] = f"""
WITH src AS (SELECT * FROM documents), {MIX_SQL}
SELECT doc_id, size, source_size, target, (size * copies)::BIGINT AS taken FROM mixed
"""


@_query
def op10_token_files(spark: SparkSession, folder: str) -> DataFrame:
    out = token_files.new_folder(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    token_files.write_token_files(_table(spark, folder, "documents"), out, path, end_id=2)
    return token_files.read_token_files(spark, out, with_ids=False)


@_query
def op9_vector_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    return vector_tree.nearest_by_tree(_table(spark, folder, "embeddings"), F.col("id") % 20 == 0)


@_query
def op2_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query
def op8_quality_cotraining(spark: SparkSession, folder: str) -> DataFrame:
    return cotraining.quality(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


@_query
def op11_vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    books = vector_codes.fit_codebooks(vectors)
    names = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"
    if books is None:
        return spark.createDataFrame([], names)
    coded = saved(vector_codes.encode(vectors, books).select("vec_id", "label", "code", "error"))
    return vector_codes.with_group_error(coded).select(
        "vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")
    )


def _full(vector: str) -> str:
    return f"{vector} IS NOT NULL AND len([z FOR z IN {vector} IF z IS NULL OR NOT isfinite(z)]) = 0"


def _gap(a: str, b: str, width: int) -> str:
    """Squared distance of two lists of whole numbers."""
    return " + ".join(f"({a}[{i}] - {b}[{i}]) * ({a}[{i}] - {b}[{i}])" for i in range(1, width + 1))


def _floored(s: str, n: str) -> str:
    """floor(s / n) of whole numbers."""
    return f"((({s}) - ((({s}) % {n}) + {n}) % {n}) // {n})::BIGINT"


def _vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6, width: int = 8) -> str:
    with_ = [
        f"""kept AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, label,
              [floor(4096 * z::DOUBLE)::BIGINT FOR z IN embedding] AS v
            FROM embeddings WHERE {_full("embedding")} AND len(embedding) = {parts * width})""",
        f"x AS MATERIALIZED (SELECT r, p, v[p * {width} + 1:p * {width} + {width}] AS a FROM kept, range({parts}) AS q(p))",
        f"""f AS (SELECT vec_id, min(v) AS v, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept
            GROUP BY vec_id ORDER BY vec_id LIMIT {entries})""",
        f"b0 AS MATERIALIZED (SELECT p, e, v[p * {width} + 1:p * {width} + {width}] AS c FROM f, range({parts}) AS q(p))",
    ]
    for i in range(rounds + 1):
        with_.append(
            f"""n{i} AS MATERIALIZED (SELECT r, p, min(a) AS a, min((({_gap("a", "c", width)}), e)) AS best
                FROM x JOIN b{i} USING (p) GROUP BY r, p)"""
        )
        if i < rounds:
            means = ", ".join(_floored(f"sum(a[{j}])", "count(*)") for j in range(1, width + 1))
            with_.append(
                f"""b{i + 1} AS MATERIALIZED (SELECT b.p, b.e, coalesce(m.c, b.c) AS c FROM b{i} AS b
                    LEFT JOIN (SELECT p, best[2] AS e, [{means}] AS c FROM n{i} GROUP BY 1, 2) AS m USING (p, e))"""
            )
    return f"""
WITH {", ".join(with_)},
o AS (SELECT r, string_agg(lpad(to_hex(best[2]), 2, '0'), '' ORDER BY p) AS code, sum(best[1])::BIGINT AS error
      FROM n{rounds} GROUP BY r),
s AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b{rounds})
SELECT vec_id, lower(code) AS code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM kept JOIN o USING (r), s
"""


SQL["op11_vector_codes"] = _vector_codes_sql()


@_query
def op12_scalar_table_clusters(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    names = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"
    centroids = scalar_tables.fit_centroids(vectors)
    if centroids is None:
        return spark.createDataFrame([], names)
    found = saved(scalar_tables.assign(vectors, centroids).select("vec_id", "cluster", "distance"))
    # One row per centroid, a fixed number.
    summed = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()
    inertia = {r["cluster"]: int(r["s"]) for r in summed}
    digests = centroids.digests()

    def of(values: list):
        return F.get(F.array(*map(F.lit, values)), F.col("cluster"))

    return found.select(
        "vec_id",
        "cluster",
        "distance",
        of([inertia.get(c, 0) for c in range(len(digests))]).cast("long").alias("cluster_inertia"),
        F.lit(sum(inertia.values())).cast("long").alias("inertia"),
        of(digests).alias("centroid_sha256"),
    )


def _scalar_tables_sql(k: int = 16, rounds: int = 3, dims: int = 64) -> str:
    with_ = [
        f"""x AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, [floor(64 * z::DOUBLE)::BIGINT FOR z IN embedding] AS a
            FROM embeddings WHERE {_full("embedding")} AND len(embedding) = {dims})""",
        f"""b0 AS MATERIALIZED (SELECT a AS c, row_number() OVER (ORDER BY sha256('1:' || vec_id), a) - 1 AS e FROM x
            ORDER BY e LIMIT {k})""",
    ]
    for i in range(rounds + 1):
        with_.append(f"n{i} AS MATERIALIZED (SELECT r, min(a) AS a, min((({_gap('a', 'c', dims)}), e)) AS best FROM x, b{i} GROUP BY r)")
        if i < rounds:
            means = ", ".join(_floored(f"sum(a[{j}])", "count(*)") for j in range(1, dims + 1))
            with_.append(
                f"""b{i + 1} AS MATERIALIZED (SELECT b.e, coalesce(m.c, b.c) AS c FROM b{i} AS b
                    LEFT JOIN (SELECT best[2] AS e, [{means}] AS c FROM n{i} GROUP BY 1) AS m USING (e))"""
            )
    return f"""
WITH {", ".join(with_)},
o AS (SELECT vec_id, best[2] AS e, best[1]::BIGINT AS distance FROM x JOIN n{rounds} USING (r))
SELECT vec_id, e::INTEGER AS cluster, distance, (sum(distance) OVER (PARTITION BY e))::BIGINT AS cluster_inertia,
  (sum(distance) OVER ())::BIGINT AS inertia, sha256(array_to_string(c, ',')) AS centroid_sha256
FROM o JOIN b{rounds} USING (e)
"""


SQL["op12_scalar_table_clusters"] = _scalar_tables_sql()

URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


@_query
def op13_url_vocabulary(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge_urls(_table(spark, folder, "pages"), URL_RULES, carry=["page_id"])


def _url_filter_sql() -> str:
    def values(rows):
        return ", ".join("(" + ", ".join(f"'{v}'" for v in r) + ")" for r in rows)

    rules = values((verdict, *rule.split("/", 1), rule) for verdict, rule in URL_RULES)
    terms = values([*((t, "strict") for t in url_filter.STRICT), *((t, "soft") for t in url_filter.SOFT if t not in url_filter.STRICT)])
    fold = f"'{url_filter.UPPER}', '{url_filter.LOWER}'"
    return rf"""
WITH u AS (SELECT row_number() OVER () AS r, page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS behind
           FROM pages),
h AS (SELECT *, translate(regexp_extract(behind, '^[^/?#]*'), {fold}) AS host, regexp_extract(behind, '^[^/?#]*([^?#]*)', 1) AS path,
        regexp_replace(translate(behind, {fold}), '%[0-9a-f][0-9a-f]', ' ', 'g') AS text FROM u),
k(verdict, rule_host, rule_path, rule) AS (VALUES {rules}),
m AS (SELECT r, max((length(rule), length(rule_host), rule, k.verdict)) AS best FROM h JOIN k
      ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, '/' || rule_path) GROUP BY r),
t(term, kind) AS (VALUES {terms}),
c AS (SELECT r, count(*) FILTER (kind = 'strict') AS strict_hits, count(*) FILTER (kind = 'soft') AS soft_hits FROM h JOIN t
      ON regexp_matches(text, '(^|[^a-z0-9])' || term || '([^a-z0-9]|$)') GROUP BY r)
SELECT page_id, host, path, best[3] AS rule, coalesce(strict_hits, 0)::INTEGER AS strict_hits, coalesce(soft_hits, 0)::INTEGER AS soft_hits,
  CASE WHEN best IS NOT NULL THEN best[4] WHEN strict_hits > 0 OR soft_hits >= {url_filter.SOFT_LIMIT} THEN 'block' ELSE 'allow' END AS verdict
FROM h LEFT JOIN m USING (r) LEFT JOIN c USING (r)
"""


SQL["op13_url_vocabulary"] = _url_filter_sql()
