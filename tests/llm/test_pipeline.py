"""The pipeline against a plain version of all its stages, and the guard at the entry."""

import os
import subprocess
import sys
from collections import Counter
from pathlib import Path

import cases
import public_tokenizers
from conftest import ROOT, TINY
from tokenizers import Tokenizer

import __spark_entry__ as entry
import corpus_pipeline


def good(text):
    words = (text or "").encode().split()
    lines = [x for x in (text or "").split("\n") if x.encode().split()]
    letters = [c for c in text or "" if c.isalpha()]
    chars = sum(len(w.decode()) for w in words)
    symbols = sum((text or "").count(c) for c in "#*$%&|<>")
    return not (
        len(words) < 50
        or 2 * cases.repeat_words(words) > len(words)
        or 10 * symbols > len(words)
        or 2 * sum(c.isupper() for c in letters) > len(letters)
        or 2 * (len(lines) - len(set(lines))) > len(lines)
        or not 2 * len(words) <= chars <= 15 * len(words)
    )


def plain(rows):
    rows = [r for r in rows if good(r["text"])]
    texts = cases.line_dedup([(r["doc_id"], r["text"]) for r in rows])
    rows = sorted(({**r, "text": texts[r["doc_id"], r["text"]]} for r in rows), key=lambda r: r["doc_id"])
    own = cases.components([cases.shingle_fingerprint(r["text"]) for r in rows])
    rows = [r for i, r in enumerate(rows) if own[i] == i]
    copies = cases.mix([(r["doc_id"], r["source"], len(r["text"].encode().split())) for r in rows])
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.TOKENIZER))
    out = Counter()
    for r in rows:
        ids = tuple(library.encode(r["text"], add_special_tokens=False).ids)
        out[r["doc_id"], r["text"], r["lang"], r["source"], len(r["text"]), ids] += copies[r["doc_id"]]
    return +out


def test_pipeline_of_documents(spark):
    docs = cases.documents(spark)
    df = entry.queries()["pipeline"](spark, TINY)
    assert df.columns == [*docs.columns, "tokens"]
    got = Counter((r["doc_id"], r["text"], r["lang"], r["source"], r["n_chars"], tuple(r["tokens"])) for r in df.collect())
    assert got == plain([r.asDict() for r in docs.collect()])


def test_stages_of_odd_documents(spark):
    """Each stage takes nulls, empty tables, repeated rows and further columns, and gives the columns that it got."""
    for table in (cases.odd(spark), cases.empty(spark)):
        docs = table
        for _, stage in corpus_pipeline.STAGES[1:]:
            docs = stage(spark, docs, TINY)
            assert docs.columns[: len(table.columns)] == table.columns
        assert (docs.count() == 0) == (table.count() == 0)
        assert corpus_pipeline.STAGES[0][1](spark, table, TINY).columns == table.columns


def test_library_works_without_the_subpackage(tmp_path):
    """A copy without chartmill/llm and corpus_pipeline.py imports, and has the other queries."""
    for p in ROOT.rglob("*.py"):
        q = p.relative_to(ROOT)
        if "llm" not in q.parts and q.name != "corpus_pipeline.py" and ".git" not in q.parts:
            (tmp_path / q).parent.mkdir(parents=True, exist_ok=True)
            (tmp_path / q).write_bytes(p.read_bytes())
    code = "import __spark_entry__ as e; q = e.queries(); assert q and not [n for n in q if n[:2] == 'op' and n[2].isdigit()]; e.oracle_sql()"
    env = os.environ | {"PYTHONPATH": str(tmp_path)}
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, env=env, check=True)
    names = entry.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11))


def test_nothing_else_imports_the_subpackage():
    for p in (ROOT / "chartmill").rglob("*.py"):
        if "llm" not in Path(p).relative_to(ROOT).parts:
            assert "chartmill.llm" not in p.read_text()
