"""Classifiers and nearest neighbours."""

import random

import cases
import numpy as np
import pytest
from conftest import TINY
from pyspark.sql import functions as F

from chartmill.llm import catalog, cotraining, logistic, toxicity, vector_tree

SMALL = "/root/testdata/sf0.01"


def judged(spark, name, label, folder=SMALL):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = catalog.QUERIES[name](spark, folder).collect()
    assert len(rows) == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.5) for r in rows)
    return [(r["predicted"], labels[r["doc_id"]]) for r in rows if r["held_out"] and r["doc_id"] in labels]


def test_toxicity_of_held_out_documents(spark):
    pairs = judged(spark, "op2_toxicity", "toxic")
    assert np.mean([p == y for p, y in pairs]) >= 0.9
    assert sum(p for p, y in pairs if not y) <= 2


def test_quality_of_held_out_documents(spark):
    pairs = judged(spark, "op8_quality_cotraining", "quality")
    assert np.mean([p == y for p, y in pairs]) >= 0.9
    assert np.mean([p for p, y in pairs if y]) >= 0.95


def test_penalty_spares_neutral_mentions(spark):
    """Toxic texts name one group more often; with the penalty its mention alone is not toxic."""
    rnd = random.Random(1)
    rows, labels = [], []
    filler = [f"word{i}" for i in range(40)]
    for i in range(600):
        toxic = i % 3 == 0
        words = rnd.sample(filler, 12)
        if rnd.random() < (0.85 if toxic else 0.05):
            words.append("muslims")
        elif rnd.random() < 0.3:
            words.append("christians")
        if toxic and rnd.random() < 0.8:
            words.append(rnd.choice(["idiots", "scum"]))
        rnd.shuffle(words)
        rows.append((i, " ".join(words) + "."))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame(labels, "doc_id long, toxic int")
    free = toxicity.train(docs, known, even=0.0)
    fair = toxicity.train(docs, known, even=30.0)
    neutral = "muslims word1 word2 word3 word4."
    assert free.score(neutral) > 0.5 > fair.score(neutral)
    assert abs(fair.score(neutral) - fair.score(neutral.replace("muslims", "christians"))) < 0.1
    assert fair.score("scum word1 word2 word3 word4.") > 0.5


def test_swapped_sentences():
    assert toxicity.counterfactuals("No one here. Some women sing. Men too.") == [
        (" some women sing", " some men sing"),
        (" some women sing", " some  sing"),
        (" men too", " girls too"),
        (" men too", "  too"),
    ]


def test_all_sentences_that_name_groups_are_swapped():
    found = toxicity.counterfactuals(" ".join(f"Say{'x' * i} women." for i in range(9)))
    assert len(found) == 18 and found[-1] == (" sayxxxxxxxx women", " sayxxxxxxxx ")


def test_models_without_labels_or_rows(spark):
    odd = cases.odd(spark)
    none = spark.createDataFrame([], "doc_id long, toxic int, quality int")
    one = spark.createDataFrame([(1, 1, 1), (None, 0, 0), (2, 5, None)], none.schema)
    for fn in (toxicity.toxicity, cotraining.quality):
        for labels, want in ((none, 0), (one, 1)):
            rows = fn(odd, labels).collect()
            assert len(rows) == len(cases.ROWS) and {r["predicted"] for r in rows} == {want}
        assert fn(cases.empty(spark), one).count() == 0
    some = spark.createDataFrame([(i, i % 2, i % 2) for i in range(1, 13)], none.schema)
    for fn in (toxicity.toxicity, cotraining.quality):
        rows = fn(odd, some).collect()
        assert len(rows) == len(cases.ROWS) and all(0 <= r["score"] <= 1 for r in rows)
        assert len({r["score"] for r in rows if r["doc_id"] == 2}) == 1
    bare = odd.select("doc_id", "text")
    assert cotraining.quality(bare, some).count() == len(cases.ROWS)


def test_drawn_labels_are_bounded_and_outside_the_held_out(spark):
    docs = spark.createDataFrame([(i, f"t{i}") for i in range(300)] + [(1, "again")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 10 == 0)) for i in range(300)] + [(2, 1)], "doc_id long, toxic int")
    rows, sizes = logistic.labelled(docs, labels, "toxic", ["text"], most=25)
    got = rows.collect()
    kept = [r["doc_id"] for r in docs.where(~logistic.held_out("doc_id")).select("doc_id").distinct().collect()]
    assert sum(sizes.values()) == len(kept)
    assert {r["id"] for r in got} <= set(kept) and len({r["id"] for r in got}) == len(got)
    assert sum(r["y"] == 0 for r in got) == 25 and sum(r["y"] for r in got) == min(25, sizes[1])


def test_views_teach_each_other():
    """One labelled row in fifty; each view sees half of the signal."""
    rng = np.random.default_rng(2)
    y = (rng.random(2000) < 0.5).astype(float)
    views = [y[:, None] * 2 + rng.normal(size=(2000, 3)) for _ in range(2)]
    few = np.arange(2000) < 40
    model = cotraining.co_train([v[few] for v in views], y[few], np.ones(40), [v[~few] for v in views], np.arange(40) % 4 == 0)
    assert model.given and max(model.given[0]) > 0
    assert ((model.score([v[~few] for v in views]) >= 0.5) == y[~few]).mean() > 0.9


def plain_search(ids, vectors, k):
    out = {}
    for q in np.flatnonzero(ids % 20 == 0):
        score = (vectors * vectors[q]).sum(axis=1)
        order = [i for i in np.lexsort((ids, -score)) if ids[i] != ids[q]][:k]
        out[int(ids[q])] = [(int(ids[i]), float(score[i])) for i in order]
    return out


@pytest.mark.parametrize("folder", [TINY, "/root/testdata/sf0.1"])
def test_tree_search_recall(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").orderBy("vec_id").collect()
    want = plain_search(np.array([r["vec_id"] for r in rows]), np.array([r["embedding"] for r in rows], float), 20)
    got = {}
    for r in catalog.QUERIES["op9_vector_tree_search"](spark, folder).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"], r["rank"]))
    assert got.keys() == want.keys()
    hits = 0
    for q, found in got.items():
        assert [x[2] for x in found] == list(range(1, 21))
        assert sorted(found, key=lambda x: (-x[1], x[0])) == found
        true = dict(want[q])
        hits += sum(i in true and abs(true[i] - s) < 1e-12 for i, s, _ in found)
    assert hits / (20 * len(want)) >= 0.9


def test_tree_search_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(20, [1.0, 0.0], 1), (20, [1.0, 0.0], 1), (40, [0.0, 2.0], 1), (1, [3.0, 0.0], 1), (2, [3.0, 0.0], 1), (3, [0.0, -1.0], 1)]
    rows += [(60, None, 1), (4, [0.0, 0.0], 1), (5, [nan, 1.0], 1), (6, [inf, 1.0], 1), (7, [None, 1.0], 1), (8, [1.0], 1), (None, [1.0, 1.0], 1), (80, [], 1)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>, id int").repartition(2)
    query = F.col("id") % 20 == 0
    got = {}
    for r in vector_tree.nearest_by_tree(table, query, k=4).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == {20: [(1, 3.0), (2, 3.0), (3, 0.0), (40, 0.0)], 40: [(1, 0.0), (2, 0.0), (20, 0.0), (20, 0.0)]}
    assert vector_tree.nearest_by_tree(table.limit(0), query).count() == 0


def test_tree_search_of_equal_vectors(spark):
    """A third of the rows are one vector, in cells smaller than that group."""
    rng = np.random.default_rng(4)
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else rng.normal(size=3).tolist()) for i in range(900)]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    want = plain_search(np.arange(900), np.array([v for _, v in rows]), 20)
    got = {}
    for r in vector_tree.nearest_by_tree(table, F.col("id") % 20 == 0, recall=1.0).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    assert np.mean([len(got[q] & {i for i, _ in w}) / 20 for q, w in want.items()]) >= 0.9
    assert got[60] == {i for i, _ in want[60]}
