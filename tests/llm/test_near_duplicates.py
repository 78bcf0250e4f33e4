import random

import cases
import numpy as np
import pytest
from conftest import TINY

from chartmill.llm import catalog, simhash_dedup
from chartmill.llm.components import components


def test_fingerprint_is_plain_simhash():
    for text in (cases.GOOD, cases.LINES, "one", "One TWO", "", "  ", "ÀÉ é A b c"):
        assert simhash_dedup.fingerprint(text.encode()) == cases.shingle_fingerprint(text)
    many = " ".join(str(i * i % 977) for i in range(70_000)).encode()
    assert simhash_dedup.fingerprint(many) == cases.shingle_fingerprint(many.decode())


@pytest.mark.parametrize("k", range(3))
def test_codes_cover_and_links_meet(k):
    rng = np.random.default_rng(k)
    code = simhash_dedup.codes()[k]
    x = rng.integers(0, 1 << 32, 4000)
    for c in code:
        words = rng.integers(0, 1 << c.length, 1000)
        home = c.home(words)
        assert (np.bitwise_count(words ^ home) <= c.radius).all()
        row, beyond = c.beyond(words)
        assert (np.bitwise_count(words[row] ^ beyond) == c.radius + 1).all()
    bit = rng.integers(0, 33, len(x))
    y = np.where(bit < 32, x ^ (1 << np.minimum(bit, 31)), x)
    _, anchor, home = simhash_dedup.anchors(x, code)
    row, reached, _ = simhash_dedup.anchors(y, code)
    there = set(zip(row.tolist(), reached.tolist()))
    assert all((i, int(a)) in there for i, a in enumerate(anchor[home]))


def test_query_against_all_pairs(spark):
    docs = cases.documents(spark).collect()
    got = {r["doc_id"]: r for r in catalog.QUERIES["op1_simhash_near_dedup"](spark, TINY).collect()}
    docs.sort(key=lambda r: r["doc_id"])
    prints = [cases.shingle_fingerprint(r["text"]) for r in docs]
    own = cases.components(prints)
    for r, p, c in zip(docs, prints, own):
        assert (got[r["doc_id"]]["fingerprint"], got[r["doc_id"]]["component_id"]) == (f"{p:016x}", docs[c]["doc_id"])


def test_chains_and_dense_groups(spark, monkeypatch):
    """Random walks three bits at a time, and a ball of close fingerprints, in cells smaller than the ball."""
    monkeypatch.setattr(simhash_dedup, "CELL", 64)
    rnd = random.Random(3)
    prints = [rnd.getrandbits(64)]
    for _ in range(150):
        prints.append(prints[-1] ^ sum(1 << b for b in rnd.sample(range(64), rnd.choice([1, 2, 3, 3, 4]))))
    centre = rnd.getrandbits(64)
    prints += [centre ^ sum(1 << b for b in rnd.sample(range(64), rnd.choice([0, 1, 2]))) for _ in range(250)]
    prints += [rnd.getrandbits(64) for _ in range(50)]
    prints = sorted({p - (1 << 64) if p >> 63 else p for p in prints})
    table = spark.createDataFrame([(p,) for p in prints], "fp long")
    found = components(simhash_dedup.links(table), "a", "b")
    root = {r["node"]: r["root"] for r in found.collect()}
    own = cases.components([p & (1 << 64) - 1 for p in prints])
    assert [root.get(p, p) for p in prints] == [prints[c] for c in own]


def test_odd_rows(spark):
    df = simhash_dedup.near_duplicates(cases.odd(spark))
    rows = df.collect()
    assert df.columns == ["doc_id", "fingerprint", "component_id"] and len(rows) == len(cases.ROWS)
    zero = {r["doc_id"]: r["component_id"] for r in rows if r["fingerprint"] == "0" * 16}
    assert zero == {3: 3, 4: 3, 5: 3}
    assert {r["component_id"] for r in rows if r["doc_id"] == 2} == {1}
    assert simhash_dedup.near_duplicates(cases.empty(spark)).count() == 0


def test_one_of_each_group_stays(spark):
    odd = cases.odd(spark)
    kept = simhash_dedup.keep_one_per_group(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in rows if r["text"] == cases.GOOD) == [(False, 1)]
    assert [r["doc_id"] for r in rows if not (r["text"] or "").split()] == [3]
    groups = simhash_dedup.near_duplicates(odd).select("fingerprint").distinct().collect()
    assert len(rows) == len(set(cases.components([int(r["fingerprint"], 16) for r in groups])))
    assert simhash_dedup.keep_one_per_group(cases.empty(spark)).count() == 0


def test_components_of_long_paths_stars_and_loops(spark):
    links = [(i, i + 1) for i in range(100, 160)] + [(500, i) for i in range(501, 560)] + [(7, 7), (5, 6), (6, 5)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "x long, y long"), "x", "y").collect()}
    assert got == {**{i: 100 for i in range(100, 161)}, **{i: 500 for i in range(500, 560)}, 5: 5, 6: 5} or got == {
        **{i: 100 for i in range(101, 161)}, **{i: 500 for i in range(501, 560)}, 6: 5
    }
    assert components(spark.createDataFrame([], "x long, y long"), "x", "y").count() == 0
