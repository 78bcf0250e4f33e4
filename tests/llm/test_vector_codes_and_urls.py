"""Vector codes, clustering by tables and URL filters: against SQL, plain versions and odd rows."""

import math
import re

import duckdb
import numpy as np
import pytest
from conftest import TINY
from oracle import compare, connect

from chartmill.llm import catalog, scalar_tables, url_filter, vector_codes
from chartmill.llm.integer_vectors import integers, largest

NAMES = ["op11_vector_codes", "op12_scalar_table_clusters", "op13_url_vocabulary"]


@pytest.mark.parametrize("name", NAMES)
def test_query_against_sql(spark, name):
    assert compare(catalog.QUERIES[name](spark, TINY), connect(TINY), catalog.SQL[name]) == []


def odd_vectors(spark, n=300):
    """Most vectors have 64 components; some are equal, and each odd case stands among them."""
    rng = np.random.default_rng(5)
    good = [[float(x) for x in v] for v in rng.normal(size=(n, 64)).astype(np.float32) * 0.2]
    rows = [(1000 - i, v, i % 3, i, None) for i, v in enumerate(good)]
    rows += [rows[7]] * 90  # one row many times
    rows += [(2000 + i, good[3], None, 5, "x") for i in range(40)]  # equal vectors, without a label
    rows += [(None, good[4], 1, 0, None), (None, good[5], 1, 0, None), (1, good[6], 9, 0, None), (1, good[2], 9, 0, None)]
    rows += [(-5, None, 1, 0, None), (-4, [], 1, 0, None), (-3, [0.5] * 63, 1, 0, None), (-2, [0.5] * 8, None, 0, None)]
    rows += [(-6, [None] + [0.5] * 63, 1, 0, None), (-7, [math.nan] + [0.5] * 63, 1, 0, None), (-8, [math.inf] * 64, 1, 0, None)]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, error int, code string")


@pytest.mark.parametrize("name", NAMES[:2])
def test_odd_vectors_against_sql(spark, tmp_path, name):
    odd_vectors(spark).repartition(5).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    df = catalog.QUERIES[name](spark, str(tmp_path))
    assert compare(df, con, catalog.SQL[name]) == [] and df.count() == 434


@pytest.mark.parametrize("name", NAMES[:2])
@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(1, [float("nan")] * 64, 1)], [(7, [0.25] * 64, None)], [(i % 3, [i / 9] * 64, i) for i in range(9)]])
def test_few_vectors_against_sql(spark, tmp_path, name, rows):
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").coalesce(1).write.parquet(f"{tmp_path}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert compare(catalog.QUERIES[name](spark, str(tmp_path)), con, catalog.SQL[name]) == []


@pytest.mark.parametrize("entries", [1, 2, 16, 200])
def test_orchard_finds_the_nearest(entries):
    rng = np.random.default_rng(entries)
    books = rng.integers(-6, 6, size=(entries, 3))  # many ties and equal entries
    points = rng.integers(-8, 8, size=(2000, 3))
    own, distance, measured = vector_codes.orchard(points, books, vector_codes.Neighbours.of(books))
    d = ((points[:, None] - books[None]) ** 2).sum(axis=2)
    assert (own == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
    assert measured <= len(points) * entries
    assert [len(x) for x in vector_codes.orchard(points[:0], books, vector_codes.Neighbours.of(books))[:2]] == [0, 0]


def test_orchard_measures_few_distances():
    rng = np.random.default_rng(1)
    books = rng.integers(-100_000, 100_000, size=(64, 4))
    points = books[rng.integers(0, 64, size=3000)] + rng.integers(-500, 500, size=(3000, 4))
    _, _, measured = vector_codes.orchard(points, books, vector_codes.Neighbours.of(books))
    assert measured < 0.3 * len(points) * len(books)


def test_codes_stand_for_their_vectors(spark):
    df = odd_vectors(spark)
    books = vector_codes.fit_codebooks(df, parts=16, entries=64, rounds=4)
    coded = vector_codes.encode(df, books)
    assert coded.columns == ["vec_id", "embedding", "label", "code", "error"]
    rows = coded.collect()
    gaps = [np.linalg.norm(np.array(books.decode(r["code"])) - np.array(r["embedding"])) for r in rows]
    norms = [np.linalg.norm(r["embedding"]) for r in rows]
    assert len(rows[0]["code"]) == 16 and np.mean(gaps) < 0.6 * np.mean(norms)
    # The error is that distance in whole-number steps, up to the step.
    assert all(abs(math.sqrt(r["error"]) / 4096 - g) < 0.01 for r, g in zip(rows, gaps))


def test_means_are_floored():
    own, points = np.array([0, 0, 1]), np.array([[-1, 3], [-2, 4], [5, -7]])
    n, s = vector_codes.group_sums(own, points, 3)
    assert n.tolist() == [2, 1, 0] and s.tolist() == [[-3, 7], [5, -7], [0, 0]]


def test_numbers_that_do_not_fit_take_no_part():
    import pyarrow as pa

    most = largest(2)
    column = pa.array([[1.0, -1.5], [float(most), 0.0], [float(most) + 1, 0.0], [1e300, 1e300], [1.7e308, 0.0]], pa.list_(pa.float64()))
    rows, points = integers(column, 2, 1)
    assert rows.tolist() == [0, 1] and points.tolist() == [[1, -2], [most, 0]]
    assert 4 * 2 * (2 * most) ** 2 < 2**63
    sliced = column.slice(1, 2)
    assert integers(sliced, 2, 1)[0].tolist() == [0]


@pytest.mark.parametrize("spread", [3, 10**6])
def test_tables_give_the_distances(spread):
    rng = np.random.default_rng(spread)
    points, centroids = rng.integers(-spread, spread, size=(5000, 5)), rng.integers(-spread, spread, size=(7, 5))
    own, distance = scalar_tables.nearest_by_tables(points, centroids)
    d = ((points[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (own == d.argmin(axis=1)).all() and (distance == d.min(axis=1)).all()
    numbers, place = scalar_tables.occurring(points[:, 0])
    assert (numbers[place] == points[:, 0]).all() and len(numbers) == len(set(points[:, 0].tolist()))


def test_clusters_keep_other_columns(spark):
    df = odd_vectors(spark).withColumnRenamed("code", "cluster").withColumnRenamed("error", "a.b")
    centroids = scalar_tables.fit_centroids(df, k=4, rounds=2)
    got = scalar_tables.assign(df, centroids)
    assert got.columns == ["vec_id", "embedding", "label", "a.b", "cluster", "distance"]
    assert got.count() == 434 and scalar_tables.assign(df.limit(0), centroids).count() == 0
    assert scalar_tables.fit_centroids(df.limit(0)) is None and vector_codes.fit_codebooks(df.limit(0)) is None


URLS = [
    None,
    "",
    "no scheme.com/en/",
    "://",
    "http://",
    "http://EXAMPLE.com/en/x",
    "http://www.Example.com/en/x?q#f",
    "http://example.com/EN/",
    "http://a.b.example.com/en/casino",
    "http://notexample.com/en/",
    "http://example.com",
    "http://com/",
    "http://com/x#y",
    "http://.com/",
    "http://x.net/es/1",
    "http://x.net/es",
    "http://net/fr/",
    "http://x.net?x=/es/",
    "http://x.net#/es/",
    "http://casino.org",
    "http://casinos-r.org",
    "http://xcasino.org/casinox/1casino/casino1",
    "http://x.org/CASINO",
    "http://x.org/a%20casino%20b",
    "http://x.org/%casino",
    "http://x.org/?q=casino",
    "casino://x.org/",
    "http://free.org/free-free",
    "http://free.org/free-BETS",
    "http://x.org/%66ree_cheap_pills",
    "http://user@free.org:80/\ncheap\n",
    "http://ünïcode.org/éwiné/Ärger",
    "http://x.org/a://casino",
    "http://" + "a." * 30_000 + "com/" + "x" * 50_000 + "-casino",
    "http://" + "a." * 30_000 + "org/" + "y/" * 50_000 + "win/free",
]


def plain_verdict(url):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    behind = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", behind)[0]
    path = re.match(r"[^?#]*", behind[len(host) :])[0]
    host = "".join(c.lower() if c.isascii() else c for c in host)
    fits = [
        (len(rule), rule, v)
        for v, rule in catalog.URL_RULES
        if (host == rule.split("/")[0] or host.endswith("." + rule.split("/")[0])) and path.startswith("/" + rule.split("/", 1)[1])
    ]
    if fits:
        return host, path, *max(fits)[1:]
    text = re.sub("%[0-9a-f]{2}", " ", "".join(c.lower() if c.isascii() else c for c in behind))
    tokens = set(re.split("[^a-z0-9]+", text))
    bad = tokens & set(url_filter.STRICT) or len(tokens & set(url_filter.SOFT)) >= url_filter.SOFT_LIMIT
    return host, path, None, "block" if bad else "allow"


def test_odd_urls(spark, tmp_path):
    df = spark.createDataFrame([(i, u, "h", "v") for i, u in enumerate([*URLS, *URLS])], "page_id long, url string, host string, verdict string")
    got = url_filter.judge_urls(df, catalog.URL_RULES)
    assert got.columns == ["page_id", "url", "host", "path", "rule", "strict_hits", "soft_hits", "verdict"]
    rows = got.collect()
    assert len(rows) == 2 * len(URLS)
    for r in rows:
        assert tuple(r[c] for c in ("host", "path", "rule", "verdict")) == plain_verdict(r["url"]), r["url"]
    assert url_filter.judge_urls(df.limit(0), catalog.URL_RULES).count() == 0
    df.select("page_id", "url").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    assert compare(catalog.QUERIES["op13_url_vocabulary"](spark, str(tmp_path)), con, catalog.SQL["op13_url_vocabulary"]) == []


def test_rules_and_terms():
    rules = url_filter.Rules([("block", "b.c/"), ("allow", "a.b.c/x"), ("block", "c/x/yyyyy"), ("allow", "c/")])
    assert rules.find("a.b.c", "/x/") == ("a.b.c/x", "allow")
    assert rules.find("a.b.c", "/x/yyyyyz") == ("c/x/yyyyy", "block")
    assert rules.find("b.c", "/") == ("b.c/", "block") and rules.find("bb.c", "/") == ("c/", "allow")
    assert rules.find("d", "/") is None and rules.find("c", "") is None and url_filter.Rules([]).find("c", "/") is None
    with pytest.raises(ValueError):
        url_filter.Rules([("deny", "c/")])
    words = url_filter.Vocabulary(["he", "she said"], ["he", "her", "hers"])
    assert words.hits("x://he-hers/her.her/she said/ushers") == (2, 2)
    assert url_filter.Vocabulary([], []).hits("x://he") == (0, 0)
