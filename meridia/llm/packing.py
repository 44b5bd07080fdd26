"""Operator 10: packing by lexical retrieval.

Documents become token ids, each ended by id 0. Whole windows of a document are sequences of their own; what is left over is a
unit. Units are packed in turns, and in each the inverted index is sharded by content: a unit's least term in an order of the
vocabulary, which changes with the turn and puts rare terms first, is its place, so that units with rare terms in common lie side
by side wherever in the corpus they come from. Two more such terms order the units of one place. Consecutive units, SHARD at most,
are a shard; a frequent place, also one of a third of all rows, goes on over as many shards as it needs. In a shard, each seed's
terms, all of them, are put to the BM25 index (document frequencies over all units), and its unused neighbours, best first,
fill its window; the last is cut at the window's end, and its rest is the next seed.

In the first turns only near neighbours fill a window (LEVELS: the least share of the seed's score for its own terms). What stays
open is one unit of the next turn, which deals by another order. In the last turn any unit of the shard will do, best first, and
what remains open then is cut into sequences of powers of two, which need no padding. A turn is linear in the input: one range
shuffle of what is open, and SHARD units against each other.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from .bpe import Encoder, Merges, chunks
from .common import materialize, slim

WINDOW = 1024
SHARD = 1024
LEVELS = (0.4, 0.2, 0.0)
COMMON = 10  # a term in more than 1 / COMMON of a shard's units is scored by the matrix product
PAIRS = 1_000_000
FEW = 32
K1, B = 1.2, 0.75
END = 0


@lru_cache(2)
def vocabulary(path: str) -> Encoder:
    """An encoder for a byte-level vocabulary in the JSON form; its special tokens' strings are ordinary text."""
    with open(path, encoding="utf-8") as file:
        data = json.load(file)
    special = {x["id"] for x in data.get("added_tokens", []) if x.get("special")}
    # printable bytes stand for themselves, the others for the signs from U+0100 on, in order
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    merged = Merges({bytes(letters[c] for c in token): i for token, i in data["model"]["vocab"].items() if i not in special})
    return Encoder(path, merged.replay)


def crc(ids: np.ndarray) -> int:
    """CRC-32 of ids as little-endian unsigned 32-bit integers."""
    return zlib.crc32(ids.astype("<u4").tobytes())


def numbers(data: bytes, n: int) -> np.ndarray:
    """n ids from the two or four bytes that each was written in."""
    return np.frombuffer(data, "<u2" if len(data) == 2 * n else "<u4")


def units(docs: DataFrame, path: str, window: int = WINDOW) -> DataFrame:
    """Rows of docs(doc_id, text) as pieces: whole windows with their sequence, and left-over units with their ids (two bytes each where all fit)."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, number = vocabulary(path), (TaskContext.get().partitionId() + 1) << 36
        for batch in chunks(batches, "text"):
            ids, counts = encoder.encode_flat([t or "" for t in batch.column("text").to_pylist()])
            stops = np.cumsum(counts)
            place, cols = [], {k: [] for k in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "ids")}
            for i, (n, stop) in enumerate(zip(counts.tolist(), stops.tolist(), strict=True)):
                own = np.append(ids[stop - n : stop], END)
                for s in range(0, n + 1, window):
                    part = own[s : s + window]
                    full = len(part) == window
                    place.append(i)
                    cols["start"].append(s)
                    cols["length"].append(len(part))
                    cols["ids_crc32"].append(crc(part) if full else None)
                    cols["doc_tokens"].append(n + 1)
                    cols["sequence_id"].append(number)
                    cols["ids"].append(None if full else part.astype("<u2" if part.max() < 1 << 16 else "<u4").tobytes())
                    number += 1
            out = {k: pa.array(v, pa.binary() if k == "ids" else pa.int64()) for k, v in cols.items()}
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id").take(pa.array(place, pa.int64())), **out})

    return docs.mapInArrow(run, f"doc_id {kind}, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, ids binary")


def frequencies(left: DataFrame) -> np.ndarray:
    """How many units hold each id, with the number of units and their total length at the end; as long as the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(1024, np.int64)
        n = total = 0
        for batch in batches:
            for x, size in zip(batch.column("ids"), batch.column("length").to_pylist(), strict=True):
                own = np.unique(numbers(x.as_py(), size))
                if own[-1] >= len(df):
                    df = np.concatenate((df, np.zeros(int(own[-1]) + 1, np.int64)))
                df[own] += 1
                n, total = n + 1, total + size
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_pydict({"id": pa.array([-2, -1, *at.tolist()], pa.int64()), "n": pa.array([total, n, *df[at].tolist()], pa.int64())})

    rows = left.select("ids", "length").mapInArrow(run, "id bigint, n bigint").groupBy("id").agg(F.sum("n").alias("n")).collect()  # one row an id of the vocabulary
    found = {r.id: r.n for r in rows}
    out = np.zeros(max([0, *found]) + 3, np.int64)
    for k, v in found.items():
        out[k] = v
    return out


def dealing_keys(df: np.ndarray, turn: int) -> np.ndarray:
    """A place for each term in three orders of this turn. The least place among a unit's terms names the unit: rare terms tend to
    come first, and two units have the same least term with the chance of their weighted overlap."""
    units_ = max(1, int(df[-1]))
    idf = np.log(1 + (units_ - df + 0.5) / (df + 0.5))
    rng = np.random.default_rng(101 + turn)
    places = -np.log(rng.random((3, len(df)))) / np.maximum(idf * idf, 1e-9)
    return np.where(df > 1, places, np.inf)  # a term of one unit has no neighbours to offer


def with_keys(pool: DataFrame, df: np.ndarray, turn: int) -> DataFrame:
    """pool with k0, k1, k2: the terms by which lexically near units come to lie side by side."""
    names = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pool.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = dealing_keys(df, turn)
        for batch in batches:
            bodies = [numbers(x.as_py(), n) for x, n in zip(batch.column("ids"), batch.column("n").to_pylist(), strict=True)]
            if not bodies:
                continue
            flat = np.concatenate(bodies)
            first = np.concatenate(([0], np.cumsum([len(b) for b in bodies])[:-1]))
            keys = []
            for own in places:
                least = np.minimum.reduceat(own[flat], first)
                at = np.flatnonzero(own[flat] == np.repeat(least, np.diff(first, append=len(flat))))
                keys.append(pa.array(flat[at[np.searchsorted(at, first)]].astype(np.int32)))
            yield pa.RecordBatch.from_arrays([*batch.columns, *keys], names=[*batch.schema.names, "k0", "k1", "k2"])

    return pool.mapInArrow(run, f"{names}, k0 int, k1 int, k2 int")


def shard_scores(bodies: list[np.ndarray], df: np.ndarray) -> np.ndarray:
    """(seeds, units): BM25 of each unit of a shard for the terms, all of them, of each other one, by the shard's inverted index.

    Postings of terms that many units hold are summed as a matrix product, the others one by one.
    """
    n = len(bodies)
    total, units_ = max(1, int(df[-2])), max(1, int(df[-1]))
    idf = np.log(1 + (units_ - df + 0.5) / (df + 0.5))
    parts = [np.unique(b, return_counts=True) for b in bodies]
    unit = np.repeat(np.arange(n), [len(t) for t, _ in parts])
    term, tf = np.concatenate([t for t, _ in parts]).astype(np.int64), np.concatenate([c for _, c in parts])
    length = np.array([len(b) for b in bodies])[unit]
    impact = (idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length * units_ / total))).astype(np.float32)
    order = np.argsort(term, kind="stable")
    unit, impact, held = unit[order], impact[order], np.bincount(term, minlength=len(df))
    first = np.cumsum(held) - held
    common = np.flatnonzero(held * COMMON > n)
    dense = np.zeros((n, len(common)), np.float32)
    for c, t in enumerate(common.tolist()):
        own = slice(first[t], first[t] + held[t])
        dense[unit[own], c] = impact[own]
    score = (dense > 0).astype(np.float32) @ dense.T
    rare = np.flatnonzero(held * COMMON <= n)
    rare = rare[held[rare] > 0]
    seeds = np.concatenate([np.arange(first[t], first[t] + held[t]) for t in rare.tolist()]) if len(rare) else np.zeros(0, np.int64)
    many, begin = np.repeat(held[rare], held[rare]), np.repeat(first[rare], held[rare])
    stops = np.cumsum(many)
    at = 0
    while at < len(seeds):  # a bounded number of posting pairs at a time
        end = max(at + 1, int(np.searchsorted(stops, (stops[at - 1] if at else 0) + PAIRS, "right")))
        m = many[at:end]
        place = np.repeat(begin[at:end] - np.cumsum(m) + m, m) + np.arange(int(m.sum()))
        score += np.bincount(np.repeat(unit[seeds[at:end]], m) * n + unit[place], impact[place], n * n).reshape(n, n)
        at = end
    return score


def cut(row: dict, a: int, n: int) -> dict:
    """The part of a unit of one or more documents' pieces from place a on, n ids long."""
    out = {"u": row["u"], "ids": row["ids"][a : a + n], "docs": [], "starts": [], "lens": [], "totals": []}
    at = 0
    for doc, start, size, total in zip(row["docs"], row["starts"], row["lens"], row["totals"], strict=True):
        low, high = max(a, at), min(a + n, at + size)
        if low < high:
            out["docs"].append(doc)
            out["starts"].append(start + low - at)
            out["lens"].append(high - low)
            out["totals"].append(total)
        at += size
    return out


def joined(rows: list[dict]) -> dict:
    """Units as one, under the first one's number."""
    return {"u": rows[0]["u"], "ids": np.concatenate([r["ids"] for r in rows]), **{k: [x for r in rows for x in r[k]] for k in ("docs", "starts", "lens", "totals")}}


def done(row: dict, sequence: int, offset: int = 0) -> dict:
    """A unit as pieces of a sequence."""
    offs = np.cumsum([0, *row["lens"]]).tolist()
    crcs = [crc(row["ids"][a:b]) for a, b in zip(offs, offs[1:])]  # noqa: B905
    return {**row, "u": sequence, "ids": None, "crcs": crcs, "offs": [offset + a for a in offs[:-1]]}


def fill_shard(rows: list[dict], df: np.ndarray, window: int, level: float) -> list[dict]:
    """Units of a shard as full windows (done) and open units. Each unused unit in turn is a seed, and its unused neighbours, best
    first, fill its window; the last is cut at the window's end and its rest is the next seed. A neighbour scores `level` times
    what the seed scores for its own terms, at least; at level 0 each unit is one, and only the last window stays open."""
    score = shard_scores([r["ids"] for r in rows], df)
    unused, out, nxt = np.ones(len(rows), bool), [], 0
    rest: tuple[int, dict] | None = None
    while True:
        if rest is None:
            while nxt < len(rows) and not unused[nxt]:
                nxt += 1
            if nxt == len(rows):
                return out
            seed, row = nxt, rows[nxt]
            unused[seed] = False
        else:
            (seed, row), rest = rest, None
        took, room = [row], window - len(row["ids"])
        if room:
            own = score[seed]
            open_ = np.flatnonzero(unused & (own >= level * own[seed]))
            if len(open_) > 4 * FEW:
                best = open_[np.argpartition(-own[open_], FEW)[:FEW]]
                if sum(len(rows[j]["ids"]) for j in best.tolist()) >= room:
                    open_ = best
            for j in open_[np.lexsort((open_, -own[open_]))].tolist():
                unused[j] = False
                n = len(rows[j]["ids"])
                took.append(rows[j] if n <= room else cut(rows[j], 0, room))
                if n > room:
                    rest = (j, cut(rows[j], room, n - room))
                room = max(0, room - n)
                if not room:
                    break
        whole = joined(took)
        out.append(whole if room else done(whole, whole["u"]))


def ended(row: dict) -> list[dict]:
    """An open unit as sequences of powers of two, which need no padding."""
    out, at = [], 0
    while at < len(row["ids"]):
        n = 1 << ((len(row["ids"]) - at).bit_length() - 1)
        out.append(done(cut(row, at, n), -1 - row["u"] * 16 - len(out)))
        at += n
    return out


def packed(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, shard: int = SHARD, levels: tuple[float, ...] = LEVELS) -> DataFrame:
    """Per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    pieces = materialize(units(slim(docs, doc_id=id_col, text=text_col), path, window), "units")
    kind, doc_type = docs.schema[id_col].dataType.simpleString(), to_arrow_type(docs.schema[id_col].dataType)
    left = pieces.filter("ids IS NOT NULL")
    df = frequencies(left)
    lists = {"docs": pa.list_(doc_type), **{k: pa.list_(pa.int64()) for k in ("starts", "lens", "totals", "crcs", "offs")}}
    schema = f"u bigint, ids binary, n bigint, docs array<{kind}>, " + ", ".join(f"{k} array<bigint>" for k in ("starts", "lens", "totals", "crcs", "offs"))

    def filler(level: float, last: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            def out(rows: list[dict]) -> pa.RecordBatch:
                made = fill_shard(rows, df, window, level)
                if last:
                    made = [x for r in made for x in ([r] if r["ids"] is None else ended(r))]
                cols = {k: pa.array([r.get(k) for r in made], t) for k, t in lists.items()}
                ids = [None if r["ids"] is None else r["ids"].tobytes() for r in made]
                sizes = [None if r["ids"] is None else len(r["ids"]) for r in made]
                return pa.RecordBatch.from_pydict({"u": pa.array([r["u"] for r in made], pa.int64()), "ids": pa.array(ids, pa.binary()), "n": pa.array(sizes, pa.int64()), **cols})

            vocabulary.cache_clear()  # a worker that has encoded before needs its words no more
            held: list[dict] = []
            for batch in batches:
                for at in range(0, batch.num_rows, shard):
                    for r in batch.slice(at, shard).to_pylist():
                        r["ids"] = numbers(r["ids"], r["n"])
                        held.append(r)
                        if len(held) == shard:
                            yield out(held)
                            held = []
            if held:
                yield out(held)

        return run

    of = {"docs": "doc_id", "starts": "start", "lens": "length", "totals": "doc_tokens"}
    pool = left.select(F.col("sequence_id").alias("u"), "ids", F.col("length").alias("n"), *[F.array(v).alias(k) for k, v in of.items()])
    n, before, ends = int(df[-1]), None, []
    for turn, level in enumerate(levels):
        order = ["k0", "k1", "k2", "u"]
        dealt = with_keys(pool, df, turn).repartitionByRange(max(1, -(-n // (8 * shard))), *order).sortWithinPartitions(*order)
        step = materialize(dealt.drop("k0", "k1", "k2").mapInArrow(filler(level, turn == len(levels) - 1), schema), "windows")
        ends.append(step.filter("ids IS NULL").drop("ids", "n"))
        pool = step.filter("ids IS NOT NULL").drop("crcs", "offs")
        n = pool.count()
    whole = pieces.filter("ids IS NULL").select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", F.lit(0).cast("long").alias("offset"))
    for x in ends:
        at = x.select("u", F.explode(F.arrays_zip("docs", "starts", "lens", "totals", "crcs", "offs")).alias("p"))
        whole = whole.unionByName(at.select(F.col("p.docs").alias("doc_id"), F.col("p.starts").alias("start"), F.col("p.lens").alias("length"), F.col("p.crcs").alias("ids_crc32"), F.col("p.totals").alias("doc_tokens"), F.col("u").alias("sequence_id"), F.col("p.offs").alias("offset")))
    return whole
