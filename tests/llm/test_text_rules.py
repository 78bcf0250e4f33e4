"""Quality rules, line and span deduplication, mixing."""

import random
import re

import cases
import numpy as np
import pytest
from conftest import TINY
from oracle import compare, connect

from chartmill.llm import catalog, line_dedup, quality_rules, source_mix, span_dedup


@pytest.mark.parametrize("name", ["op3_line_dedup", "op4_quality_rules", "op6_source_mix"])
def test_query_against_sql(spark, name):
    assert compare(catalog.QUERIES[name](spark, TINY), connect(TINY), catalog.SQL[name]) == []


def test_cascade_of_odd_rows(spark):
    df = quality_rules.cascade(cases.odd(spark), measures=quality_rules.MEASURES, sample_rows=5)
    assert df.columns == [*cases.odd(spark).columns, *quality_rules.MEASURES, "kept"]
    rows = df.collect()
    assert len(rows) == len(cases.ROWS)
    for r in rows:
        words = (r["text"] or "").encode().split()
        assert r["n_words"] == len(words) and r["n_repeat_words"] == cases.repeat_words(words)
        assert r["word_chars"] == sum(len(w.decode()) for w in words)
        good = [not rule.rejects(quality_rules.Document((r["text"] or "").encode())) for rule in quality_rules.RULES]
        assert r["kept"] == all(good)
    assert not any(r["kept"] for r in rows)  # short, or the same words again and again
    assert quality_rules.cascade(cases.empty(spark)).count() == 0


def test_cascade_asks_good_cheap_rules_first():
    rules = [quality_rules.Rule(n, None) for n in ("slow", "cheap", "never")]
    seen = [
        quality_rules.Estimate("slow", 100, 50, 5.0),
        quality_rules.Estimate("cheap", 100, 20, 0.1),
        quality_rules.Estimate("never", 100, 0, 0.1),
    ]
    assert [r.name for r in quality_rules.ordered(rules, seen)] == ["cheap", "slow", "never"]


def test_cascade_stops_at_the_first_rejection(spark):
    def fails(document):
        raise AssertionError("asked after a rejection")

    rules = [quality_rules.Rule("all", lambda d: True), quality_rules.Rule("late", fails)]
    estimates = [quality_rules.Estimate("all", 1, 1, 1.0), quality_rules.Estimate("late", 1, 0, 1.0)]
    plan = quality_rules.ordered(rules, estimates)
    assert any(r.rejects(quality_rules.Document(b"x")) for r in plan)


def test_line_dedup_of_odd_rows(spark):
    df = line_dedup.remove_repeated_lines(cases.odd(spark))
    assert df.columns == [*cases.odd(spark).columns, "n_lines", "n_removed"]
    want = cases.line_dedup([r[:2] for r in cases.ROWS])
    rows = df.collect()
    assert len(rows) == len(cases.ROWS)
    before = {}
    for r in rows:
        before.setdefault((r["doc_id"], r["source"], r["n_chars"]), r)
    for row in cases.ROWS:
        r = before[row[0], row[3], row[4]]
        assert r["text"] == want[row[:2]]
        assert r["n_lines"] == (0 if row[1] is None else row[1].count("\n") + 1)
    assert line_dedup.remove_repeated_lines(cases.empty(spark)).count() == 0


def test_line_dedup_of_documents(spark):
    docs = cases.documents(spark)
    want = cases.line_dedup([(r["doc_id"], r["text"]) for r in docs.collect()])
    got = {r["doc_id"]: r["text"] for r in line_dedup.remove_repeated_lines(docs).collect()}
    assert got == {i: t for (i, _), t in want.items()}
    plan = line_dedup.remove_repeated_lines(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_sentences_join_to_the_text():
    for text in (cases.GOOD, cases.LINES, " a. b!? c\n\n d " * 20, "x" * 500, "", cases.LONG[:5000]):
        assert "".join(span_dedup.sentences(text)) == text
    assert max(len(s.split()) for s in span_dedup.sentences(cases.GOOD * 3)) <= 16


def plain_cuts(words):
    """The words that a piece of a long sentence starts with, by looking at each window on its own."""
    ends = np.cumsum([len(w) + 1 for w in words])
    buf = np.frombuffer(b" ".join([*words, b""]), np.uint8)
    own = span_dedup._word_hashes(buf, ends - [len(w) + 1 for w in words], ends - 1)
    pairs = [int(x) for x in span_dedup._mixed(own[:-1] * np.uint64(span_dedup._RUN_FACTORS[1]) + own[1:])]
    recurs = {i for i, h in enumerate(pairs) if h in pairs[max(0, i - 10) : i] or h in pairs[i + 1 : i + 11]}
    chosen = set()
    for i in range(len(pairs) - 7):
        window = [k for k in range(i, i + 8) if k not in recurs]
        if window:
            chosen.add(min(window, key=lambda k: pairs[k]) + 1)
    out, at = [], 0
    for c in [*sorted(chosen), len(words)]:
        out += [*range(at + 16, c, 16), c]
        at = c
    return out[:-1]


def test_sentences_are_cut_where_each_window_says():
    rng = random.Random(3)
    texts = [" ".join(rng.choice(("a", "b,", "of.", "the\n", "longer", "é")) for _ in range(rng.randrange(80))) for _ in range(60)]
    texts += ["aa " * 100, " x", ". . .\n\n", cases.GOOD * 2, " ".join(f"w{i * i % 97}" for i in range(200))]
    for text in texts:
        want = []
        for part in re.split(r"(?<=[.!?])(?=[\x20\x09-\x0D])|(?<=\n)", text):
            words = part.encode().split()
            at = [m.start() for m in re.finditer(r"[^\x20\x09-\x0D]+", part)]
            cuts = [at[c] for c in plain_cuts(words)] if len(words) > 8 else []
            want += [part[a:b] for a, b in zip([0, *cuts], [*cuts, len(part)]) if part]
        assert span_dedup.sentences(text) == want


def test_span_dedup_when_a_third_of_the_rows_is_one_document(spark):
    hot = " ".join(f"Sentence {i} of the hot document says {i * 31 % 101}." for i in range(40))
    rows = [(i, hot if i % 3 == 0 else " ".join(f"w{i}x{k}" for k in range(40))) for i in range(3, 300)]
    rows += [(None, hot), (None, hot), (3, hot)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for r in span_dedup.remove_repeated_spans(docs).collect():
        if r["doc_id"] == 3:
            assert r["text"] == hot and r["n_removed"] == 0
        elif r["doc_id"] is None or r["doc_id"] % 3 == 0:
            assert len(r["text"].split()) < 24, r
        else:
            assert r["n_removed"] == 0


def plain_span_dedup(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0])):
        if text is None:
            out[doc_id] = None
            continue
        parts = span_dedup.sentences(text)
        at = [i for i, p in enumerate(parts) if p.encode().split()]
        gone = set()
        for k in range(len(at)):
            end = next((e for e in range(k + 2, len(at) + 1) if sum(len(parts[i].encode().split()) for i in at[k:e]) >= 24), None)
            if end is None:
                break
            span = tuple(w for i in at[k:end] for w in parts[i].encode().split())
            if span in seen:
                gone |= set(range(at[k], at[end - 1] + 1))
            seen.add(span)
        out[doc_id] = "".join(p for i, p in enumerate(parts) if i not in gone)
    return out


def test_span_dedup_of_documents(spark):
    docs = cases.documents(spark)
    got = span_dedup.remove_repeated_spans(docs).collect()
    assert {r["doc_id"]: r["text"] for r in got} == plain_span_dedup([(r["doc_id"], r["text"]) for r in docs.collect()])
    assert all((r["n_removed"] > 0) or r["text"] is not None for r in got)


def test_span_dedup_finds_a_passage_in_other_text(spark):
    passage = " ".join(f"This is sentence {i} of a passage that is copied." for i in range(8))
    alone = "A sentence " + "that is one long run of words without an end " * 6
    rows = [(1, "Own start. " + passage + " Own end."), (2, f"Other start here!\n{passage}\nOther end."), (3, alone), (4, "x y. " + alone)]
    got = {r["doc_id"]: r["text"] for r in span_dedup.remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[1] == rows[0][1] and got[3] == alone
    assert "passage" not in got[2] and "Other start" in got[2] and "Other end." in got[2]
    assert len(got[4].split()) <= 18


def test_span_dedup_finds_an_unpunctuated_passage_at_every_offset(spark):
    passage = [f"p{i * 7919 % 10007}" for i in range(60)]
    rows = [(0, " ".join(["first", "own", "words", *passage, *(f"f{i}" for i in range(40))]))]
    for k in range(1, 17):
        rows.append((k, " ".join([*(f"b{k}x{i}" for i in range(k + 20)), *passage, *(f"a{k}x{i}" for i in range(30))])))
    got = {r["doc_id"]: r["text"] for r in span_dedup.remove_repeated_spans(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got[0] == rows[0][1]
    for k in range(1, 17):
        left = got[k].split()
        assert [w for w in left if w[0] != "p"] == [w for w in rows[k][1].split() if w[0] != "p"]
        stay = [passage.index(w) for w in left if w[0] == "p"]
        assert not set(stay) & set(range(15, 45)), (k, stay)


def test_span_dedup_of_odd_rows(spark):
    rows = span_dedup.remove_repeated_spans(cases.odd(spark)).collect()
    assert len(rows) == len(cases.ROWS)
    text = {(r["doc_id"], r["source"]): r["text"] for r in rows}
    assert text[1, "b"] == cases.GOOD and text[2, "a"] == "" and text[3, None] is None and text[8, "b"] == cases.LONG
    assert span_dedup.remove_repeated_spans(cases.empty(spark)).count() == 0


def test_mix_against_plain_version(spark):
    docs = cases.documents(spark)
    rows = [(r["doc_id"], r["source"], len(r["text"].encode().split())) for r in docs.collect()]
    got = source_mix.mix(docs).collect()
    assert {r["doc_id"]: r["copies"] for r in got} == cases.mix(rows)
    assert all(r["taken"] == r["copies"] * r["size"] <= 2 * r["size"] for r in got)
    by = {}
    for r in got:
        s = by.setdefault(r["source"], [r["target"], 0, 0])
        s[1] += r["taken"]
        s[2] = max(s[2], r["size"])
    assert all(abs(taken - target) <= biggest / 2 + 1 for target, taken, biggest in by.values())


def test_mix_of_repeated_rows_and_null_ids(spark):
    rows = [(1, "w " * 50, "a", "u")] * 200 + [(i, "x " * (i % 13 + 1), "a", "u") for i in range(2, 200)]
    rows += [(None, "z " * (i % 17 + 1) + str(i % 40), "b", "u" if i % 2 else None) for i in range(300)]
    rows += [(i, "y " * 20, "c", None) for i in range(1000, 1100)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, url string").repartition(5)
    got = source_mix.mix(df).collect()
    assert sorted(map(str, ((r["doc_id"], r["text"], r["source"], r["url"]) for r in got))) == sorted(map(str, rows))
    for source in "abc":
        own = [r for r in got if r["source"] == source]
        assert abs(sum(r["taken"] for r in own) - own[0]["target"]) <= max(r["size"] for r in own) / 2
        assert max(r["copies"] for r in own) - min(r["copies"] for r in own) <= 1
    assert len({r["copies"] for r in got if r["doc_id"] == 1}) == 2
    again = source_mix.mix(df.repartition(3)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))


def test_mix_of_odd_rows(spark):
    df = source_mix.mix(cases.odd(spark))
    assert df.columns == [*cases.odd(spark).columns, "size", "source_size", "target", "copies", "taken"]
    rows = df.collect()
    assert len(rows) == len(cases.ROWS)
    assert {r["size"] for r in rows if not (r["text"] or "").strip()} == {0}
    assert sorted(map(str, rows)) == sorted(map(str, source_mix.mix(cases.odd(spark)).collect()))
    assert source_mix.repeated(df).count() == sum(r["copies"] for r in rows)
    assert source_mix.mix(cases.empty(spark)).count() == 0


def test_water_filling_reshapes_until_feasible(spark):
    table = spark.createDataFrame([("a", 10, 3), ("b", 100, 1), ("c", 1000, 2), ("d", 0, 3)], "src string, size long, weight long")
    got = {r["src"]: r["target"] for r in source_mix.water_fill(table, (3, 2), 2).collect()}
    assert got["a"] == 20.0 and got["d"] == 0.0 and got["b"] == 200.0 and got["c"] == 1665.0 - 220.0
