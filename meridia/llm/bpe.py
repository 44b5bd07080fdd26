"""Operator 1: byte-level BPE encoding and decoding by corpus-level merge replay.

Each task takes its slice of the corpus in chunks of bounded size, gathers the distinct words of the chunk and keeps
an inverted index from token pair to the positions in those words where the pair stands. Every merge is applied in rank
order at all its positions at once, and only the touched neighbours are looked up again. No row leaves its partition.

Defined cases: null text is empty; an empty text has 0 tokens and the digests of nothing; repeated rows give repeated
results; a null doc_id stays null; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .common import slim

NONE = np.int32(2**31 - 1)
CHUNK_CHARS = 16_000_000  # bytes of text whose new words are merged at once
SPLIT_CHARS = 1_000_000  # signs of text split into words at once
KEEP_WORDS = 1_500_000  # words remembered from chunk to chunk
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3
CUT = re.compile(r"\S(?=[ \n])")


@lru_cache(1)
def char_classes() -> np.ndarray:
    """White space, letter, number or other for each code point, by the regex library's Unicode tables."""
    table = np.full(0x110000, OTHER, np.uint8)
    text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(pattern, text):
            a, b = ord(m[0][0]), ord(m[0][-1])
            if b - a + 1 == len(m[0]):
                table[a : b + 1] = kind
            else:  # a run over the surrogates' gap
                table[[ord(c) for c in m[0]]] = kind
    return table


def split_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Matches of the byte-level pattern in each text: code points of all texts, ends of the matches among these, matches per text.

    The pattern's alternatives say: a run of letters, numbers or other signs takes one U+0020 that stands before it;
    a run of white space leaves its last sign to what follows; a contraction at the start of a match goes first.
    """
    points = np.frombuffer("".join(texts).encode("utf-32-le"), np.uint32)
    stops = np.cumsum(np.array([len(t) for t in texts], np.int64))
    n = len(points)
    if not n:
        return points, np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    kind = char_classes()[points]
    starts, first = np.empty(n, bool), np.zeros(n + 1, bool)
    first[0] = True
    first[stops] = True
    starts[0] = True
    np.not_equal(kind[1:], kind[:-1], out=starts[1:])
    space = kind == SPACE
    last = space[:-1] & ~space[1:] & ~first[1:n]  # white space right before something else: a match starts at it
    starts[:-1] |= last
    starts[1:][last & (points[:-1] == 0x20)] = False
    starts |= first[:n]
    at = np.flatnonzero((points == 0x27) & starts)
    if len(at):
        limit = stops[np.searchsorted(stops, at, "right")]
        for c in CONTRACTIONS:
            here = at[at + len(c) <= limit]
            for k in range(1, len(c)):
                here = here[points[here + k] == ord(c[k])]
            for k in range(1, len(c)):
                starts[here + k] = False
            end = here + len(c)
            starts[end[end < n]] = True
    ends = np.append(np.flatnonzero(starts)[1:], n)
    return points, ends, np.diff(np.searchsorted(ends, stops, "right"), prepend=0)


class Merges:
    """The merge table of a vocabulary of (bytes -> rank)."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.size = max(ranks.values()) + 1
        self.bytes: list[bytes] = [b""] * self.size
        for k, v in ranks.items():
            self.bytes[v] = k
        keys, out = [], []
        for k, v in ranks.items():
            for i in range(1, len(k)):
                a, b = ranks.get(k[:i]), ranks.get(k[i:])
                if a is not None and b is not None:
                    keys.append(a * self.size + b)
                    out.append(v)
        order = np.argsort(np.array(keys, np.int64))
        self.keys, self.values = np.array(keys, np.int64)[order], np.array(out, np.int32)[order]
        self.single = np.array([ranks[bytes([i])] for i in range(256)], np.int32)
        a, b = np.divmod(np.arange(1 << 16), 256)
        self.first = self.lookup(self.single[a], self.single[b])  # ranks of pairs of bytes
        self.lengths = np.array([len(x) for x in self.bytes], np.int64)

    def lookup(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE where no merge joins it or a side is the end of a word (-1)."""
        key = a.astype(np.int64) * self.size + b
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        return np.where((self.keys[at] == key) & (a >= 0) & (b >= 0), self.values[at], NONE)

    def one(self, word: bytes) -> list[int]:
        """A single word, merge by merge: for the rare words in which a merge makes a pair of lower rank."""
        parts = [bytes([c]) for c in word]
        while len(parts) > 1:
            least, at = min((self.ranks.get(parts[i] + parts[i + 1], NONE), i) for i in range(len(parts) - 1))
            if least == NONE:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.ranks[x] for x in parts]

    def replay(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all words one after another, and how many each word has."""
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        whole = [self.ranks.get(w, -1) for w in words]
        open_ = [i for i, r in enumerate(whole) if r < 0 and words[i]]
        ids, counts = self._merge([words[i] for i in open_])
        n = np.array([0 if not w else 1 for w in words], np.int64)
        n[open_] = counts
        start = np.cumsum(n) - n
        out = np.empty(int(n.sum()), np.int32)
        done = np.array(whole, np.int64)
        known = np.flatnonzero(done >= 0)
        out[start[known]] = done[known]
        if open_:
            out[np.repeat(start[open_] - (np.cumsum(counts) - counts), counts) + np.arange(len(ids))] = ids
        return out, n

    def _merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if not words:
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        lengths = np.array([len(w) for w in words], np.int64)
        # Every word is followed by one place that holds -1, so that no pair crosses its end.
        raw = np.frombuffer(b"\0".join(words) + b"\0", np.uint8)
        ends = np.cumsum(lengths + 1) - 1
        tok = self.single[raw]
        tok[ends] = -1
        n = len(tok)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        after[-1] = n - 1
        before[0] = n - 1
        rank = np.full(n, NONE, self.first.dtype)
        rank[:-1] = self.first[raw[:-1].astype(np.int32) * 256 + raw[1:]]
        rank[ends] = NONE
        rank[ends[ends > 0] - 1] = NONE
        index: list[list[np.ndarray]] = [[] for _ in range(self.size)]

        def file(places: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            places, ranks = places[order], ranks[order]
            cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            for part, r in zip(np.split(places, cuts), ranks[np.concatenate(([0], cuts))].tolist(), strict=True):
                index[r].append(part)

        live = np.flatnonzero(rank != NONE)
        if len(live):
            file(live, rank[live])
        odd: list[np.ndarray] = []
        for r in range(self.size):
            if not index[r]:
                continue
            places = index[r][0] if len(index[r]) == 1 else np.concatenate(index[r])
            index[r] = []
            places = places[rank[places] == r]
            if not len(places):
                continue
            if len(places) > 1:
                places.sort()
                again = places[1:] == places[:-1]
                if again.any():
                    places = places[np.concatenate(([True], ~again))]
            right = after[places]
            if len(places) > 1:
                touch = right[:-1] == places[1:]
                if touch.any():  # in a chain of overlapping pairs every second one, from the left
                    first = np.flatnonzero(np.concatenate(([True], ~touch)))
                    nth = np.arange(len(places)) - np.repeat(first, np.diff(np.append(first, len(places))))
                    places = places[nth % 2 == 0]
                    right = after[places]
            far = after[right]
            tok[places] = r
            after[places] = far
            before[far] = places
            rank[right] = NONE
            tok[right] = -2
            left = before[places]
            made = np.concatenate((places, left))
            ranks = self.lookup(tok[made], tok[np.concatenate((far, places))])
            rank[made] = ranks  # a place before a word's start holds -1 and gets NONE
            ok = ranks != NONE
            if ok.any():
                made, ranks = made[ok], ranks[ok]
                if (ranks <= r).any():
                    odd.append(made[ranks <= r])
                    made, ranks = made[ranks > r], ranks[ranks > r]
                if len(made):
                    file(made, ranks)
        mine = np.searchsorted(ends, np.arange(n))
        keep = tok >= 0
        counts = np.bincount(mine[keep], minlength=len(words)).astype(np.int64)
        ids = tok[keep]
        if odd:
            redo = set(np.searchsorted(ends, np.concatenate(odd)).tolist())
            parts = np.split(ids, np.cumsum(counts)[:-1])
            for i in redo:
                parts[i] = np.array(self.one(words[i]), np.int32)
            counts = np.array([len(p) for p in parts], np.int64)
            ids = np.concatenate(parts)
        return ids.astype(np.int32), counts


@lru_cache(2)
def encoder(path: str) -> Encoder:
    """One for all tasks of a worker, which so keep the words that they share."""
    return Encoder(path)


@lru_cache(4)
def merges(path: str) -> Merges:
    """The vocabulary in the rank file at path, read once a worker."""
    with open(path, "rb") as file:
        return Merges({base64.b64decode(a): int(b) for a, b in map(bytes.split, file)})


def _upto(x: int, n: int) -> np.ndarray:
    out = np.full(n + 1, x, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def pieces(text: str) -> Iterator[str]:
    """A text cut after about SPLIT_CHARS where a blank follows another sign: a match of the pattern always begins there."""
    at = 0
    while len(text) - at > SPLIT_CHARS and (m := CUT.search(text, at + SPLIT_CHARS)):
        yield text[at : m.end()]
        at = m.end()
    yield text[at:]


@lru_cache(1)
def _powers() -> tuple[np.ndarray, ...]:
    """Two odd multipliers' powers modulo 2**64, and those of their inverses, as far as a chunk may go at first."""
    out = []
    for p in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F):
        for x in (p, pow(p, -1, 2**64)):
            out.append(_upto(x, SPLIT_CHARS))
    return tuple(out)


def word_keys(points: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two independent 64-bit keys of each word, from running sums of its code points."""
    powers = _powers()
    starts = np.concatenate(([0], ends[:-1]))
    low = points.astype(np.uint64)
    low *= np.uint64(0xD6E8FEB86659FD93)
    low ^= low >> np.uint64(29)
    low += np.uint64(0x632BE59BD9B4E019)
    out, n = [], len(points)
    for k in (0, 2):
        power, back = powers[k], powers[k + 1]
        if n >= len(power):  # one very long text
            power, back = _upto(power[1], n), _upto(back[1], n)
        run = np.empty(n + 1, np.uint64)
        run[0] = 0
        np.cumsum(low * power[:n], out=run[1:])
        key = (run[ends] - run[starts]) * back[starts]
        key ^= key >> np.uint64(31)
        out.append(key)
    return out[0], out[1]


class Encoder:
    """Encodes texts chunk by chunk. Words keep their ids from chunk to chunk while memory allows.

    A word is known by 64 bits of its content; 64 further bits are compared at each occurrence, so that words that
    agree in the first by chance are told apart.
    """

    def __init__(self, path: str, learn=None):
        self.path, self.learn = path, learn or merges(path).replay
        self._forget()

    def _forget(self) -> None:
        self.keys, self.checks = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        self.ids, self.starts, self.counts = np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def encode_flat(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and how many each text has. Words are found part by part, a very long text in
        pieces; the new ones of all parts are merged together."""
        if len(self.keys) > KEEP_WORDS:
            self._forget()
        parts: list[list[str]] = [[]]
        owner, room = [], SPLIT_CHARS
        for i, t in enumerate(texts):
            for piece in pieces(t) if len(t) > SPLIT_CHARS else (t,):
                if parts[-1] and len(piece) > room:
                    parts.append([])
                    room = SPLIT_CHARS
                parts[-1].append(piece)
                room -= len(piece)
                owner.append(i)
        done = self._encode_parts(parts)
        n = np.bincount(np.array(owner, np.int64), np.concatenate([c for _, c in done]), len(texts)).astype(np.int64)
        return np.concatenate([ids for ids, _ in done]), n

    def _encode_parts(self, parts: list[list[str]]) -> list[tuple[np.ndarray, np.ndarray]]:
        """Of each part the ids, and how many each text has."""
        found = [self._split(part) for part in parts]
        if not self._learn([x for x in found if len(x) == 5]):  # words of two parts agree in a key by chance
            out = []
            for part in parts:
                self._forget()
                out += self._encode_parts([part])
            return out
        out = []
        for x in found:
            if len(x) == 5:
                keys, code, per_text = x[:3]
                at = self._places(keys)
                x = self._gather(self.ids, self.starts[at], self.counts[at], code, per_text)
            out.append(x)
        return out

    def _split(self, texts: list[str]):
        """The words of a part: their distinct keys, which of these each word has, words per text, and the new keys' checks and
        words. Without words, or where words agree in a key by chance, the part's ids and counts."""
        points, ends, per_text = split_words(texts)
        if not len(ends):
            return np.zeros(0, np.int32), np.zeros(len(texts), np.int64)
        key, check = word_keys(points, ends)
        code, keys = pd.factorize(key)
        one = np.empty(len(keys), np.int64)
        one[code[::-1]] = np.arange(len(code))[::-1]
        at = self._places(keys)
        at[at == len(self.keys)] = 0
        known = self.keys[at] == keys if len(self.keys) else np.zeros(len(keys), bool)
        torn = len(self.keys) and (self.checks[at[known]] != check[one[known]]).any()
        if torn or (check[one][code] != check).any():  # two words under one key: both keys together tell them apart
            _, one, code = np.unique(np.stack((key, check)), axis=1, return_index=True, return_inverse=True)
            ids, counts = self.learn(self._words(points, ends, one))
            return self._gather(ids, np.cumsum(counts) - counts, counts, code, per_text)
        new = np.flatnonzero(~known)
        return keys, code, per_text, (keys[new], check[one[new]]), self._words(points, ends, one[new])

    def _places(self, keys: np.ndarray) -> np.ndarray:
        """np.searchsorted in the known keys, in order: much faster than by random places."""
        order = np.argsort(keys)
        out = np.empty(len(keys), np.int64)
        out[order] = np.searchsorted(self.keys, keys[order])
        return out

    def _learn(self, parts: list[tuple]) -> bool:
        """Merges the new words of all parts and keeps their ids; false if their keys don't tell them apart."""
        fresh = np.concatenate([x[3][0] for x in parts]) if parts else np.zeros(0, np.uint64)
        if not len(fresh):
            return True
        checks, words = np.concatenate([x[3][1] for x in parts]), [w for x in parts for w in x[4]]
        keys, first = np.unique(fresh, return_index=True)
        if (checks[first][np.searchsorted(keys, fresh)] != checks).any():
            return False
        ids, counts = self.learn([words[i] for i in first.tolist()])
        every = np.concatenate((self.keys, keys))
        order = np.argsort(every)
        self.keys, self.checks = every[order], np.concatenate((self.checks, checks[first]))[order]
        self.starts = np.concatenate((self.starts, len(self.ids) + np.cumsum(counts) - counts))[order]
        self.counts = np.concatenate((self.counts, counts))[order]
        self.ids = np.concatenate((self.ids, ids))
        return True

    @staticmethod
    def _words(points: np.ndarray, ends: np.ndarray, which: np.ndarray) -> list[bytes]:
        stop = ends[which]
        start = np.where(which > 0, ends[which - 1], 0)
        n = stop - start
        flat = points[np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))].tobytes().decode("utf-32-le")
        cut = np.cumsum(n).tolist()
        return [flat[a:b].encode() for a, b in zip([0, *cut], cut)]  # noqa: B905

    @staticmethod
    def _gather(ids: np.ndarray, starts: np.ndarray, counts: np.ndarray, code: np.ndarray, per_text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = counts[code]
        upto = np.cumsum(n)
        out = ids[np.repeat(starts[code] - (upto - n), n) + np.arange(int(upto[-1]))]
        stops = np.cumsum(per_text)
        return out, np.diff(np.concatenate(([0], upto))[stops], prepend=0)

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text, as int32."""
        ids, n = self.encode_flat(texts)
        return np.split(ids, np.cumsum(n)[:-1]) if len(texts) else []

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes that ids stand for."""
        known = merges(self.path).bytes
        return b"".join([known[i] for i in ids.tolist()])


def chunks(batches: Iterator[pa.RecordBatch], column: str, limit: int = CHUNK_CHARS) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about `limit` bytes of text, and one row at least."""
    for batch in batches:
        sizes = np.array([0 if v is None else v for v in pa.compute.binary_length(batch.column(column)).to_pylist()], np.int64)
        at, n = 0, batch.num_rows
        while at < n:
            end = max(at + 1, at + int(np.searchsorted(np.cumsum(sizes[at:]), limit, "right")))
            yield batch.slice(at, end - at)
            at = end


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: id, n_tokens, ids_sha256 and decoded_sha256; with_ids adds the ids as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = encoder(path)
        for batch in chunks(batches, "text"):
            found = own.encode([t or "" for t in batch.column("text").to_pylist()])
            cols = {
                "doc_id": batch.column("doc_id"),
                "n_tokens": pa.array([len(x) for x in found], pa.int64()),
                "ids_sha256": pa.array([hashlib.sha256(x.astype("<u4").tobytes()).hexdigest() for x in found], pa.string()),
                "decoded_sha256": pa.array([hashlib.sha256(own.decode(x)).hexdigest() for x in found], pa.string()),
            }
            if with_ids:
                cols["ids"] = pa.array([x.tolist() for x in found], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_pydict(cols)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"doc_id {kind}, n_tokens bigint, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if with_ids else "")
    return slim(docs, doc_id=id_col, text=text_col).mapInArrow(run, schema)


def decode_ids(encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """Per row: id and the bytes of an array of ids; null ids give null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = merges(path).bytes
        for batch in batches:
            out = [None if x is None else b"".join(known[i] for i in x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "decoded": pa.array(out, pa.binary())})

    kind = encoded.schema[id_col].dataType.simpleString()
    return slim(encoded, doc_id=id_col, ids=ids_col).mapInArrow(run, f"doc_id {kind}, decoded binary")
