"""Byte-pair encoding as a bounded-lookahead transducer, and decoding as a state machine from bytes to text.

**Merging.** :class:`Bpe` holds a public tokenizer file's vocabulary and merge list and applies it to many short
pieces at once, with arrays: each step finds every piece's best-ranked pair and merges it.

**Lookahead.** What follows a text can change its tokens only through a chain of merges, each of which takes the
token at the place changed so far, or a prefix of it, as its right part and so moves that place left by its left
part. Ranks rise along a chain. The longest chain in bytes (:attr:`Bpe.lookahead`) is therefore enough: a token
that ends that far before the end of what has been read stays, whatever comes. Merging restarts after it.

**Streaming.** :class:`StreamEncoder` reads text in windows. It cuts where no token can cross (before a space after
a non-space; at any white space where the tokenizer drops it), emits pieces once they are complete, and inside a piece
longer than a window emits tokens once they are stable by the lookahead. Where the tokenizer normalises and lower-cases,
such a piece is folded first, up to a character that does not combine with what stands before it, and split
after that. Memory is bounded by the window, not by the text (a run of nothing but combining marks is held whole).

Texts must be valid Unicode. Pieces of characters for which libraries may differ by their Unicode version are
encoded by the tokenizers library itself; so is whatever may hold a special token.
"""

from __future__ import annotations

import codecs
import json
import re
import unicodedata
from collections.abc import Iterable, Iterator
from functools import cached_property

import numpy as np
import regex
from tokenizers import Tokenizer

#: How byte-level tokenizers split text.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

#: Characters that all Unicode versions treat alike and no normalisation changes.
PLAIN = re.compile("[\n -~¡-ɏ]*")
#: No whole number: a pair that does not merge.
NEVER = np.int32(2**31 - 1)
#: Longest piece to be remembered, in characters.
SHORT = 40
#: Most pieces, and most words, remembered; a memo then starts anew.
MEMO = 200_000


def byte_characters() -> dict[str, int]:
    """The characters that stand for bytes in byte-level vocabularies: printable ones stand for themselves."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class PairTable:
    """(left, right) -> rank and merged token, for arrays of pairs; open addressing with linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, merged: np.ndarray):
        self.bits = max(8, int(len(left)).bit_length() + 2)
        size = 1 << self.bits
        self.keys = np.full(size, -1, np.int64)
        self.ranks = np.full(size, NEVER, np.int32)
        self.merged = np.zeros(size, np.int32)
        keys = left.astype(np.int64) << 32 | right
        at, todo = self._slot(keys), np.arange(len(keys))
        while len(todo):
            free = todo[self.keys[at[todo]] == -1]
            slot, first = np.unique(at[free], return_index=True)
            new = free[first]
            self.keys[slot], self.ranks[slot], self.merged[slot] = keys[new], new, merged[new]
            todo = todo[self.keys[at[todo]] != keys[todo]]
            at[todo] = (at[todo] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Slot of each pair, or -1."""
        keys = left.astype(np.int64) << 32 | right
        slot = self._slot(keys)
        there = self.keys[slot]
        found = np.where(there == keys, slot, -1)
        todo = np.flatnonzero((there != keys) & (there != -1))
        while len(todo):
            slot[todo] = (slot[todo] + 1) & (len(self.keys) - 1)
            there = self.keys[slot[todo]]
            hit = there == keys[todo]
            found[todo[hit]] = slot[todo[hit]]
            todo = todo[~hit & (there != -1)]
        return found


class Bpe:
    """A byte-level BPE tokenizer from a file of the tokenizers library."""

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("dropout") or model.get("continuing_subword_prefix") or model.get("ignore_merges"):
            raise ValueError("not a plain byte-level BPE file")
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.lower = bool(spec.get("normalizer"))
        #: White space neither makes tokens nor joins words.
        self.drops_space = self.lower
        split = next((p["pattern"]["Regex"] for p in (spec["pre_tokenizer"].get("pretokenizers") or []) if p["type"] == "Split"), None)
        self.pattern = regex.compile(split or BYTE_LEVEL_PATTERN)
        self.merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.pairs = PairTable(*(np.array([self.vocab[x] for x in column], np.int32) for column in (*zip(*self.merges), [a + b for a, b in self.merges])))
        self.of_char = byte_characters()
        self.unit = np.zeros(256, np.int32)
        self.last_unit = np.zeros(256, np.int32)
        for c, b in self.of_char.items():
            self.unit[b] = self.vocab[c]
            self.last_unit[b] = self.vocab[c + self.suffix]
        self.dtype = np.dtype("<u2" if max([*self.vocab.values(), *self.special.values()]) < 1 << 16 else "<u4")
        self.memo: dict[str, bytes] = {}
        self.word_ids: dict[bytes, bytes] = {}
        self.decimals: dict[str, bytes] = {}

    @cached_property
    def token_bytes(self) -> list[bytes]:
        """The bytes that each id stands for (special tokens: their text)."""
        table = [b""] * (max([*self.vocab.values(), *self.special.values()]) + 1)
        for token, i in self.vocab.items():
            token = token.removesuffix(self.suffix) if self.suffix else token
            table[i] = bytes(self.of_char[c] for c in token)
        for token, i in self.special.items():
            table[i] = token.encode()
        return table

    @cached_property
    def lookahead(self) -> int:
        """Bytes that decide the tokens before them: the longest chain of merges, by left parts. See the module."""
        made = {*self.of_char, *(c + self.suffix for c in self.of_char)}
        longest: dict[str, int] = {}
        for a, b in self.merges:
            if a not in made or b not in made:
                raise ValueError("a merge uses a token that no earlier merge makes")
            made.add(a + b)
            plain = b.removesuffix(self.suffix) if self.suffix else b
            reach = max((longest.get(plain[:k], 0) for k in range(1, len(plain) + 1)), default=0)
            longest[a] = max(longest.get(a, 0), len(a) + reach)
        return max(longest.values(), default=0) + 1

    def merge(self, pieces: list[bytes], complete: bool = True) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and how many each has. ``complete``: the pieces end words."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        data = np.frombuffer(b"".join(pieces), np.uint8)
        ids = self.unit[data]
        own = np.repeat(np.arange(len(pieces)), lengths)
        if complete and len(data):
            ends = np.cumsum(lengths)[lengths > 0] - 1
            ids[ends] = self.last_unit[data[ends]]
        done_ids, done_own = [], []
        while len(ids):
            slot = self.pairs.find(ids[:-1], ids[1:])
            slot[own[:-1] != own[1:]] = -1
            rank = np.append(np.where(slot >= 0, self.pairs.ranks[slot], NEVER), NEVER)
            starts = np.flatnonzero(np.append(True, own[1:] != own[:-1]))
            sizes = np.diff(np.append(starts, len(own)))
            best = np.repeat(np.minimum.reduceat(rank, starts), sizes)
            at = np.flatnonzero((rank == best) & (rank != NEVER))
            if len(at):
                # Of overlapping pairs (a run of one token) every other one merges, from the left.
                run = np.cumsum(np.append(0, np.diff(at) != 1))
                first = np.append(0, np.flatnonzero(np.diff(run)) + 1)
                at = at[(np.arange(len(at)) - first[run]) % 2 == 0]
                ids[at] = self.pairs.merged[slot[at]]
            over = best == NEVER
            done_ids.append(ids[over])
            done_own.append(own[over])
            keep = ~over
            keep[at + 1] = False
            ids, own = ids[keep], own[keep]
        if not done_ids:
            return np.zeros(0, self.dtype), lengths
        own = np.concatenate(done_own)
        ids = np.concatenate(done_ids)[np.argsort(own, kind="stable")]
        return ids.astype(self.dtype), np.bincount(own, minlength=len(pieces))

    def words(self, piece: str) -> list[bytes]:
        """The parts of a plain piece that merges never cross."""
        text = piece.lower() if self.lower else piece
        letters = text[1:] if text[:1] == " " else text
        if letters.isalpha():
            return [text.encode()]
        if letters[:-1].isalpha() and letters[-1] in ".,;:!?":
            return [text[:-1].encode(), text[-1:].encode()]
        return [w.encode() for w in self.pattern.findall(text)]

    def pieces(self, text: str) -> list[str]:
        """Cut a whole text where no token crosses: before each space after a non-space, or at white space that is dropped."""
        if self.drops_space:
            return list(filter(None, text.replace("\n", " ").split(" ")))
        if "\0" in text or _SPACES.search(text):
            return [p for p in _CUT.split(text) if p]
        return [p for p in text.replace(" ", "\0 ").split("\0") if p]

    def learn(self, pieces: Iterable[str]) -> None:
        """Encode the pieces that the memo lacks, all at once."""
        if len(self.memo) > MEMO:
            self.memo.clear()
            self.decimals.clear()
        if len(self.word_ids) > MEMO:
            self.word_ids.clear()
        missing = set(pieces).difference(self.memo)
        plain, words, counts = [], [], []
        for p in missing:
            if p.isalpha() and p.isascii():
                plain.append(p)
                words.append((p.lower() if self.lower else p).encode())
                counts.append(1)
            elif PLAIN.fullmatch(p) and "<|" not in p:
                found = self.words(p)
                plain.append(p)
                words += found
                counts.append(len(found))
            else:
                self._remember(p, np.array(self.library.encode(p, add_special_tokens=False).ids, self.dtype))
        of = self.word_ids
        new = [w for w in dict.fromkeys(words) if w not in of]
        ids, sizes = self.merge(new)
        ends = (np.cumsum(sizes) * self.dtype.itemsize).tolist()
        packed = ids.tobytes()
        of.update(zip(new, map(packed.__getitem__, map(slice, [0, *ends], ends))))
        at = 0
        for p, n in zip(plain, counts):
            self.memo[p] = of[words[at]] if n == 1 else b"".join([of[w] for w in words[at : at + n]])
            at += n

    def _remember(self, piece: str, ids: np.ndarray) -> None:
        self.memo[piece] = ids.tobytes()

    def decimal(self, piece: str) -> bytes:
        """Ids of a learnt piece as decimals joined by commas."""
        found = self.decimals.get(piece)
        if found is None:
            found = self.decimals[piece] = decimals(np.frombuffer(self.memo[piece], self.dtype))
        return found


_SPACES = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S)(?= )")


#: Characters of a text that are read at once.
WINDOW = 1 << 16


def decimals(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


class StreamEncoder:
    """Text in, in windows; out come pieces (to be learnt and looked up) and, from overlong pieces, arrays of ids."""

    def __init__(self, bpe: Bpe, window: int = WINDOW):
        self.bpe = bpe
        self.window = max(window, 8)
        self.held = ""  # characters not yet emitted
        self.word = b""  # bytes of an unfinished overlong word, from a stable token boundary on
        self.inside: regex.Pattern | None = None  # what continues that word
        self.folded = ""  # of an overlong piece, normalised and not yet emitted
        self.longest = max(map(len, bpe.special), default=0)

    def feed(self, text: str) -> Iterator[str | np.ndarray]:
        for start in range(0, len(text), self.window):
            self.held += text[start : start + self.window]
            yield from self._drain()

    def finish(self) -> Iterator[str | np.ndarray]:
        if self.folded or self.bpe.lower and self.inside:
            yield from self._fold(True)
        elif self.inside:
            yield from self._overlong(True)
        yield from self.bpe.pieces(self.held)
        self.held = ""

    def _drain(self) -> Iterator[str | np.ndarray]:
        if self.folded or self.inside:
            yield from self._fold(False) if self.bpe.lower else self._overlong(False)
            if self.folded or self.inside:
                return
        cut = self._last_cut(self.held)
        if cut:
            yield from self.bpe.pieces(self.held[:cut])
            self.held = self.held[cut:]
        if len(self.held) > self.window:
            yield from self._fold(False) if self.bpe.lower else self._overlong(False)

    def _last_cut(self, text: str) -> int:
        if self.bpe.drops_space:
            return max(0, *(text.rfind(c) for c in " \n\t\r"))
        at = text.rfind(" ")
        while at > 0 and text[at - 1].isspace():
            at = text.rfind(" ", 0, at)
        return max(at, 0)

    def _overlong(self, end: bool) -> Iterator[str | np.ndarray]:
        """Emit from a piece that has outgrown the window: whole words while they end in it, else stable tokens."""
        bpe = self.bpe
        while True:
            special = min((i for i in (self.held.find(s) for s in bpe.special) if i >= 0), default=-1)
            # A special token ends what stands before it; the start of one may stand at the end.
            text = self.held[:special] if special >= 0 else self.held
            closed = end or special >= 0
            safe = len(text) if closed else len(text) - max(self.longest, 4)
            at = 0
            if self.inside:
                run = self.inside.match(text)
                at = run.end() if run else 0
                spaces = self.inside is _CLASSES[3]
                over = at < safe if not closed else True
                if not over:
                    at = max(safe, 0)
                elif spaces and at and at < len(text):
                    at -= 1  # the last white space before a word is the word's
                self.word += text[:at].encode()
                yield from self._tokens(over)
                self.held = self.held[at:]
                if not over:
                    return
                self.inside = None
                continue
            while at < safe:
                m = bpe.pattern.match(text, at)
                if m is None or m.end() >= safe and not closed:
                    break
                yield text[m.start() : m.end()]
                at = m.end()
            self.held = self.held[at:]
            if closed and special >= 0:
                yield np.array([bpe.special[s] for s in bpe.special if self.held.startswith(s, special - at)][:1], bpe.dtype)
                self.held = self.held[special - at :]
                self.held = self.held[len(next(s for s in bpe.special if self.held.startswith(s))) :]
                continue
            if closed or len(self.held) <= self.window:
                return
            first = self.held
            lead = 1 if first[0] == " " and len(first) > 1 and not first[1].isspace() else 0
            self.inside = next(c for c in _CLASSES if c.match(first, lead))
            self.word = b" " if lead else b""
            self.held = first[lead:]

    def _fold(self, end: bool) -> Iterator[np.ndarray]:
        """Emit from an overlong piece of a tokenizer that folds text: fold what cannot change any more, then split."""
        bpe = self.bpe
        while True:
            stops = [i for i in (self.held.find(s) for s in bpe.special) if i >= 0]
            gap = _GAP.search(self.held)
            stops += [gap.start()] if gap else []
            closed = end or bool(stops)
            upto = min(stops, default=len(self.held)) if closed else _boundary(self.held, len(self.held) - max(self.longest, 4))
            self.folded += bpe.library.normalizer.normalize_str(self.held[:upto]) if upto else ""
            self.held = self.held[upto:]
            yield from self._split(closed)
            special = next((s for s in bpe.special if self.held.startswith(s)), None) if closed else None
            if special is None:
                return
            yield np.array([bpe.special[special]], bpe.dtype)
            self.held = self.held[len(special) :]
            if not end and len(self.held) <= self.window:
                return

    def _split(self, closed: bool) -> Iterator[np.ndarray]:
        """Tokens of folded text: of words that are complete, and stable ones of a word that outgrows the window."""
        bpe, text, words, at = self.bpe, self.folded, [], 0
        if self.inside:
            run = self.inside.match(text)
            at = run.end() if run else 0
            over = closed or at < len(text)
            self.word += text[:at].encode()
            yield from self._tokens(over)
            if not over:
                self.folded = ""
                return
            self.inside = None
        while at < len(text):
            m = bpe.pattern.search(text, at)
            # What follows could lengthen the last word, also to a contraction.
            if m is None or not closed and m.end() > len(text) - 4:
                at = m.start() if m else len(text)
                break
            words.append(m.group().encode())
            at = m.end()
        if words:
            yield bpe.merge(words)[0]
        self.folded = text[at:]
        if len(self.folded) > self.window and not closed:
            self.inside = next(c for c in _CLASSES if c.match(self.folded))
            self.word = b""
            yield from self._split(closed)

    def _tokens(self, over: bool) -> Iterator[np.ndarray]:
        """Tokens of the unfinished word that nothing to come can change; all of them if it is over."""
        bpe = self.bpe
        if over:
            if self.word:
                yield bpe.merge([self.word])[0]
            self.word = b""
        elif len(self.word) > 2 * bpe.lookahead:
            ids, _ = bpe.merge([self.word], complete=False)
            ends = np.cumsum([len(bpe.token_bytes[i]) for i in ids.tolist()])
            n = int(np.searchsorted(ends, len(self.word) - bpe.lookahead, side="right"))
            if n:
                yield ids[:n]
                self.word = self.word[int(ends[n - 1]) :]


_CLASSES = [regex.compile(p) for p in (r"\p{L}+", r"\p{N}+", r"[^\s\p{L}\p{N}]+", r"\s+")]
_GAP = regex.compile(r"\s")


def _boundary(text: str, at: int) -> int:
    """The last place up to ``at`` whose character never combines with the one before it: no mark, no part of a syllable."""
    while at > 0:
        c = text[at]
        if c < "\u0300" or unicodedata.category(c)[0] != "M" and not ("\u1100" <= c <= "\u11ff" or "\ud7b0" <= c <= "\ud7ff"):
            return at
        at -= 1
    return 0


class StreamDecoder:
    """Ids in, text out: bytes are kept back only while they are the start of a character."""

    def __init__(self, bpe: Bpe):
        self.table = bpe.token_bytes
        self.utf8 = codecs.getincrementaldecoder("utf-8")(errors="replace")

    def feed(self, ids: np.ndarray) -> str:
        return self.utf8.decode(b"".join(map(self.table.__getitem__, ids.tolist())))

    def finish(self) -> str:
        return self.utf8.decode(b"", final=True)


def encode(bpe: Bpe, text: str) -> np.ndarray:
    """Ids of one text."""
    stream = StreamEncoder(bpe)
    items = [*stream.feed(text), *stream.finish()]
    bpe.learn(x for x in items if isinstance(x, str))
    packed = [bpe.memo[x] if isinstance(x, str) else x.astype(bpe.dtype).tobytes() for x in items]
    return np.frombuffer(b"".join(packed), bpe.dtype)
