"""Small tables with every odd case, and plain versions of the operators."""

from __future__ import annotations

import hashlib
from collections import Counter

import xxhash

#: Columns of ``documents``, and others whose names operators use inside.
SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, "
    "k1 string, H1 int, pos int, c0 int, fp string, id string, src double, `a.b` int, root int"
)
CLASHES = ("k1", 1, 2, 3, "fp", "id", 0.5, 7, 9)

LINES = "One line of several words here.\nAnother line that follows the first.\nAnd a third line to end the window."
GOOD = " ".join(f"word{i} goes on, and so it was." for i in range(30))
LONG = "\n".join(f"Sentence {i} of a very long text, with number {i * 7919 % 10007} in it." for i in range(12_000))

ROWS = [
    (1, GOOD, "en", "b", 10, *CLASHES),
    (2, GOOD, "en", "a", None, *CLASHES),
    (2, GOOD, "en", "a", None, *CLASHES),
    (3, None, None, None, None, *[None] * 9),
    (4, "", "en", "a", 0, *CLASHES),
    (5, " \t\n \x0b", "en", "a", 5, *CLASHES),
    (6, "one", "en", "c", 3, *CLASHES),
    (7, "One TWO", "en", "c", 7, *CLASHES),
    (8, LONG, "en", "b", len(LONG), *CLASHES),
    (9, LINES + "\n" + LINES + "\nlast", "en", "b", 1, *CLASHES),
    (None, "before\n" + LINES, "de", None, 2, *CLASHES),
    (10, "\n\n\n\n" + LINES, "de", "", 2, *CLASHES),
    (11, "x " * 400, "fr", "d", 800, *CLASHES),
    (None, GOOD, "en", "b", 10, *CLASHES),
    (12, "çà et là, naïve 漢字 😀 <|endoftext|> Σίσυφος", "fr", "d", 40, *CLASHES),
]


def odd(spark):
    return spark.createDataFrame(ROWS, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def documents(spark, folder="/root/testdata/sf0.001"):
    return spark.read.parquet(f"{folder}/documents.parquet")


# Plain versions.


def shingle_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i : i + 3]), 42) for i in range(max(1, len(words) - 2))]
    return sum(1 << k for k in range(64) if 2 * sum(h >> k & 1 for h in hashes) > len(hashes))


def components(prints, most=3):
    """Position of the first member of each one's component, by trying all pairs."""
    own = list(range(len(prints)))
    near = [[j for j, q in enumerate(prints) if (p ^ q).bit_count() <= most] for p in prints]
    while True:
        new = [min(own[j] for j in js) for js in near]
        if new == own:
            return own
        own = new


def repeat_words(words):
    windows = list(zip(words, words[1:], words[2:]))
    often = {w for w, n in Counter(windows).items() if n > 1}
    return len({i + k for i, w in enumerate(windows) if w in often for k in range(3)})


def line_dedup(rows):
    """{(doc_id, text): text} with lines of windows taken out that occur earlier; rows in document order."""
    seen, out = set(), {}
    for doc_id, text in sorted(set(rows), key=lambda r: (r[0] is None, r[0])):
        if text is None:
            out[doc_id, text] = None
            continue
        lines = text.split("\n")
        gone = set()
        for i in range(len(lines) - 2):
            w = tuple(lines[i : i + 3])
            if any(x.encode().split() for x in w):
                if w in seen:
                    gone |= {i, i + 1, i + 2}
                seen.add(w)
        out[doc_id, text] = "\n".join(x for i, x in enumerate(lines) if i not in gone)
    return out


def mix(rows, weights=(3, 1, 2)):
    """{doc_id: copies} of (doc_id, source, size): water-filling by fractions of epochs, then nearest in hash order."""
    from fractions import Fraction

    sources = sorted({s for _, s, _ in rows}, key=lambda s: (s is None, s or ""))
    size = {s: sum(n for _, x, n in rows if x == s) for s in sources}
    weight = {s: weights[i % 3] for i, s in enumerate(sources)}
    total, full = Fraction(3 * sum(size.values()), 2), set()
    while True:
        left = total - sum(2 * size[s] for s in full)
        w = sum(weight[s] for s in sources if s not in full)
        share = {s: Fraction(2 * size[s]) if s in full else left * weight[s] / w for s in sources}
        over = {s for s in sources if share[s] > 2 * size[s]}
        if not over:
            break
        full |= over
    copies = {}
    for s in sources:
        own = sorted((hashlib.md5(f"mix:{i}".encode()).hexdigest(), i, n) for i, x, n in rows if x == s)
        whole = share[s] // size[s] if size[s] else 0
        rest, run, best = share[s] - whole * size[s], 0, (None, 0)
        ends = [(abs(rest), 0)]
        for k, (_, _, n) in enumerate(own):
            run += n
            ends.append((abs(run - rest), k + 1))
        best = min(ends)[1] if rest > 0 else 0
        for k, (_, i, n) in enumerate(own):
            copies[i] = int(whole) + (k < best and n > 0)
    return copies
