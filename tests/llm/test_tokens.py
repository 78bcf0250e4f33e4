"""Byte-pair encoding, streams and token files, against the tokenizers library."""

import hashlib
import random
import zlib

import cases
import numpy as np
import public_tokenizers
import pytest
from conftest import TINY
from tokenizers import Tokenizer

from chartmill.llm import bpe, catalog, token_files, token_streams

FILES = ["byte_bpe_50k.json", "word_bpe_49k.json"]
PIECES = ["a", "b", "the", "e", " ", "  ", "\n", "\t", " \n", "'", "'s", "'re", "1", "23", "é", "ß", "漢", "字", "<|endoftext|>", "<|", "|>"]
PIECES += ["!", "...", "\xa0", "é", "Σ", "😀", "x" * 30, "\x1c", "ing", "\r\n", "<|startoftext|>", "ẞ", "İ"]


@pytest.fixture(scope="module", params=FILES)
def both(request):
    path = public_tokenizers.path(request.param)
    library = Tokenizer.from_file(path)
    return bpe.Bpe(path), lambda t: library.encode(t, add_special_tokens=False).ids


def test_encoding_is_the_library_s(spark, both):
    own, library = both
    rnd = random.Random(5)
    texts = ["".join(rnd.choice(PIECES) for _ in range(rnd.randint(0, 25))) for _ in range(1500)]
    texts += [r["text"] for r in cases.documents(spark).limit(60).collect()]
    assert [bpe.encode(own, t).tolist() for t in texts] == [library(t) for t in texts]


def test_streams_of_small_windows_give_the_same(both):
    """Overlong words and runs, fed in odd chunks through windows much shorter than they are."""
    own, library = both
    rnd = random.Random(7)
    kinds = [["a", "b", "th", "e", "ing", "er"], ["1", "2"], ["!", ".", "-", "="], ["\n", "\t", " ", "\n\n"], ["é", "ß", "a", "漢"]]
    kinds += [["ab", "1", "!", "'s", "'", "x", "<|endoftext|>", " "], ["a"]]
    kinds += [["IT'S", "'S", "'RE", "WE'LL", "'"], ["cafe\u0301", "e\u0301", "J\u030c", "A\u030a\u0301", "İ", "x"], ["\u1112\u1161\u11ab", "가", "\u0915\u093f", "漢"]]
    kinds += [["It'S\n", "e\u0301\n", "word\n"], ["\u0301", "\u0307"], ["<|EndOfText|>", "<|endoftext|>", "A", "'VE"], ["a\u2003", "B\x85", "c\t"]]
    for n in range(112):
        text = "".join(rnd.choice(kinds[n % len(kinds)]) for _ in range(rnd.randint(1500, 4000))) + rnd.choice(["", " end", "x", "\nz"])
        stream, items, at = bpe.StreamEncoder(own, window=rnd.choice([64, 200, 700])), [], 0
        most = 0
        while at < len(text):
            step = rnd.choice([50, 333, 1000])
            items += stream.feed(text[at : at + step])
            most = max(most, len(stream.held) + len(stream.folded) + len(stream.word))
            at += step
        items += stream.finish()
        own.learn(x for x in items if isinstance(x, str))
        packed = b"".join(own.memo[x] if isinstance(x, str) else x.astype(own.dtype).tobytes() for x in items)
        assert np.frombuffer(packed, own.dtype).tolist() == library(text)
        # Marks alone can change their order, so a run of them is held whole.
        assert most <= stream.window * 3 + 4 * own.lookahead + 64 or kinds[n % len(kinds)] == ["\u0301", "\u0307"]


@pytest.mark.parametrize("text", ["IT'S\n" * 20_000, "cafe\u0301\n" * 16_666, "IT'S" * 20_000, "Cafe\u0301" * 14_000, "Σ" * 70_000, "漢\u3099字" * 25_000])
def test_long_stretches_without_a_space(both, text):
    own, library = both
    assert bpe.encode(own, text).tolist() == library(text)


def test_lookahead_bounds_what_a_continuation_changes(both):
    own, _ = both
    rnd = random.Random(11)
    for _ in range(40):
        word = "".join(rnd.choice(["a", "an", "the", "ing", "er", "tion", "s", "e"]) for _ in range(900)).encode()
        cut = rnd.randint(1500, len(word)) if len(word) > 1500 else len(word)
        ids, _ = own.merge([word[:cut]], complete=False)
        ends = np.cumsum([len(own.token_bytes[i]) for i in ids.tolist()])
        stable = ids[ends <= cut - own.lookahead].tolist()
        assert own.merge([word])[0].tolist()[: len(stable)] == stable


def test_decoder_holds_back_parts_of_characters():
    own = bpe.Bpe(public_tokenizers.path(FILES[0]))
    library = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    rnd = random.Random(3)
    for ids in (bpe.encode(own, "漢字 😀 é").tolist(), [rnd.randrange(50257) for _ in range(300)], [own.unit[0xE6], own.unit[0xFF], own.unit[0x9F]]):
        decoder = bpe.StreamDecoder(own)
        text = "".join(decoder.feed(np.array([i])) for i in ids) + decoder.finish()
        assert text == library.decode(list(map(int, ids)), skip_special_tokens=False)


def test_a_long_text_leaves_window_by_window(spark, both):
    """Two megabytes in one text, with long stretches without a space: no step hands out more than a few windows' worth."""
    own, library = both
    text = ("the cat sat on " * 3000 + "ab1!" * 40_000 + "IT'S\n" * 30_000 + " <|endoftext|> 漢字 " * 4000) * 4
    ids, most = [], 0
    for items in token_streams.windows(own, text):
        found = [own.memo[x] if isinstance(x, str) else x.astype(own.dtype).tobytes() for x in items]
        most = max(most, sum(map(len, found)) // own.dtype.itemsize)
        ids += np.frombuffer(b"".join(found), own.dtype).tolist()
    assert ids == library(text)
    assert most <= 4 * bpe.WINDOW < len(ids)


def test_digests_of_long_and_short_texts_side_by_side(spark):
    path = public_tokenizers.path(FILES[0])
    library = Tokenizer.from_file(path)
    texts = ["a b", "x" * 200_000 + " end", "", "a b", "word " * 30_000, "漢" * 70_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    got = {r["doc_id"]: tuple(r)[1:] for r in token_streams.round_trip_digests(rows, path).collect()}
    for i, text in enumerate(texts):
        ids = library.encode(text, add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        assert got[i] == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())


def test_round_trip_query(spark):
    library = Tokenizer.from_file(public_tokenizers.path(FILES[0]))
    got = {r["doc_id"]: r for r in catalog.QUERIES["op7_bpe_round_trip"](spark, TINY).collect()}
    for r in cases.documents(spark).collect():
        ids = library.encode(r["text"], add_special_tokens=False).ids
        decoded = library.decode(ids, skip_special_tokens=False)
        want = (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest())
        assert tuple(got[r["doc_id"]])[1:] == want


def test_odd_documents_round_trip(spark):
    odd, path = cases.odd(spark), public_tokenizers.path(FILES[0])
    tokens = token_streams.encode_documents(odd, path)
    assert tokens.columns == [*odd.columns, "tokens"]
    back = token_streams.decode_documents(tokens.withColumnRenamed("text", "before"), path)
    rows = back.collect()
    assert len(rows) == len(cases.ROWS) and all(r["text"] == (r["before"] or "") for r in rows)
    assert token_streams.encode_documents(cases.empty(spark), path).count() == 0
    empty = hashlib.sha256(b"").hexdigest()
    digests = token_streams.round_trip_digests(odd, path).where("doc_id in (3, 4)").collect()
    assert [tuple(r)[1:] for r in digests] == [(0, empty, empty)] * 2
    assert token_streams.round_trip_digests(cases.empty(spark), path).count() == 0


def test_token_files_query(spark):
    library = Tokenizer.from_file(public_tokenizers.path(FILES[1]))
    got = {r["doc_id"]: tuple(r)[1:] for r in catalog.QUERIES["op10_token_files"](spark, TINY).collect()}
    start = 0
    for r in cases.documents(spark).orderBy("doc_id").collect():
        ids = [*library.encode(r["text"], add_special_tokens=False).ids, 2]
        assert got[r["doc_id"]] == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)


def test_files_of_long_stretches(spark, tmp_path):
    """Lines of single words, upper-case contractions and separate accents: more than a window without a space."""
    path = public_tokenizers.path(FILES[1])
    library = Tokenizer.from_file(path)
    texts = {1: "IT'S\n" * 20_000, 2: "cafe\u0301" * 15_000, 3: "end"}
    token_files.write_token_files(spark.createDataFrame(list(texts.items()), "doc_id long, text string"), str(tmp_path), path, end_id=2)
    got, start = {r["doc_id"]: r for r in token_files.read_token_files(spark, str(tmp_path)).collect()}, 0
    for i, text in texts.items():
        ids = [*library.encode(text, add_special_tokens=False).ids, 2]
        assert (got[i]["start"], got[i]["ids"]) == (start, ids)
        start += len(ids)


def test_files_of_odd_documents(spark, tmp_path):
    path, folder = public_tokenizers.path(FILES[0]), str(tmp_path)
    parts = token_files.write_token_files(cases.odd(spark), folder, path, end_id=50256)
    assert parts == token_files.read_index(folder)
    rows = sorted(token_files.read_token_files(spark, folder).collect(), key=lambda r: r["start"])
    assert len(rows) == len(cases.ROWS)
    ids = [r["doc_id"] for r in rows]
    assert ids[-2:] == [None, None] and ids[:-2] == sorted(ids[:-2])
    library = Tokenizer.from_file(path)
    want = sorted(
        ((r[0] is None, r[0] or 0), [*library.encode(r[1] or "", add_special_tokens=False).ids, 50256]) for r in cases.ROWS
    )
    assert sorted(((r["doc_id"] is None, r["doc_id"] or 0), r["ids"]) for r in rows) == want
    assert [token_files.document_ids(folder, parts, i).tolist() for i in range(len(rows))] == [r["ids"] for r in rows]
    assert rows[0]["start"] == 0 and all(a["start"] + a["n_tokens"] == b["start"] for a, b in zip(rows, rows[1:]))
    none = str(tmp_path / "none")
    assert token_files.write_token_files(cases.empty(spark), none, path) == []
    assert token_files.read_token_files(spark, none).count() == 0
