"""Operator 9: substring dedup by content-defined chunks.

A gear hash rolls over a text's UTF-8 bytes; a chunk ends where the hash's top bits are zero, after LEAST bytes at least and
MOST at most, so that an insertion only moves the ends near it. Chunks are named by a 64-bit digest. A digest that occurs in
two or more documents is shared; consecutive shared chunks of a text are a run. A run loses what stands before its first common end
and after its last: so runs of few words are candidates only, and both ends of each are compared byte by byte with a document that
shares the chunk there, and moved as far as both agree. What then has WORDS words or more is a repeated passage. It is reported in
parts, one for each document that has the part's chunks first: where that is another one, `kept` is false, so that each chunk stays
in one document when these parts are taken away.

Digests are counted with a partial aggregation, so a passage of very many documents is summed where it is read; the few bytes around
a chunk of a very common passage are fetched once, and joined to the runs that need them.

Defined cases: null text is empty and has no chunks; repeats inside one document aren't reported; rows that repeat an id are
one document, each with runs of its own (with other texts under one id, ends may be compared with either); rows with a null id take
no part; an empty table gives an empty result; other columns are ignored. Digests have 64 bits: a chance collision adds one chunk.
In a text that repeats one word over and over chunks are alike at many places, and ends are compared at one of them: such a passage
may come out shorter, or be missed when it has few more than WORDS words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import chunks
from .common import discard, materialize, slim

LEAST, MOST, BITS = 12, 128, 4
RUN_WORDS = 6  # word starts of a candidate
WORDS = 50  # word starts of a passage
AROUND = 256  # bytes compared at either end


def _gear() -> np.ndarray:
    return np.random.default_rng(101).integers(0, 2**32, 256, np.uint32)


GEAR = _gear()


def rolling(data: np.ndarray) -> np.ndarray:
    """The gear hash at each byte: the sum of the last 32 bytes' gears, each shifted by its age; by doubling spans."""
    h = GEAR[data]
    for span in (1, 2, 4, 8, 16):
        older = h[:-span] << np.uint32(span) if len(h) > span else h[:0]
        h = h.copy()
        h[span:] += older
    return h


def cuts(data: bytes) -> np.ndarray:
    """Ends of the chunks of data."""
    if not data:
        return np.zeros(0, np.int64)
    marks = (np.flatnonzero(rolling(np.frombuffer(data, np.uint8)) >> np.uint32(32 - BITS) == 0) + 1).tolist()
    out, at, n = [], 0, len(data)
    for m in marks:
        while m - at > MOST:
            at += MOST
            out.append(at)
        if m - at >= LEAST:
            at = m
            out.append(at)
    while n - at > MOST:
        at += MOST
        out.append(at)
    if at < n:
        out.append(n)
    return np.array(out, np.int64)


def document_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, digests, stops, words) for docs(doc_id, text): parallel arrays, one entry a chunk; words counts the word starts in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 2_000_000):
            cols: dict[str, list] = {"digests": [], "stops": [], "words": []}
            for t in batch.column("text").to_pylist():
                data = (t or "").encode()
                end = cuts(data)
                stops = end.tolist()
                cols["digests"].append([xxhash.xxh3_64_intdigest(data[a:b]) - 2**63 for a, b in zip([0, *stops], stops)])  # noqa: B905
                cols["stops"].append(stops)
                raw = np.frombuffer(data, np.uint8)
                blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
                begins = np.concatenate(([0], np.cumsum(~blank & np.concatenate(([True], blank))[: len(blank)])))
                cols["words"].append(np.diff(begins[np.concatenate(([0], end))]).tolist())
            kinds = {"digests": pa.int64(), "stops": pa.int32(), "words": pa.int32()}
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), **{k: pa.array(v, pa.list_(kinds[k])) for k, v in cols.items()}})

    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, digests array<bigint>, stops array<int>, words array<int>")


def surroundings(docs: DataFrame, asked: DataFrame) -> DataFrame:
    """(doc_id, at, left, bytes) for asked(doc_id, at, left): the bytes before `at`, or from the one before `at` on, of docs(doc_id, text)."""
    by = asked.distinct().groupBy("doc_id").agg(F.collect_list(F.struct("at", "left")).alias("asked"))  # as many as a text has chunks
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 2_000_000):
            place, at, left, out = [], [], [], []
            for i, (t, want) in enumerate(zip(batch.column("text"), batch.column("asked").to_pylist(), strict=True)):
                data = (t.as_py() or "").encode()
                for x in want:
                    place.append(i)
                    at.append(x["at"])
                    left.append(x["left"])
                    out.append(data[max(0, x["at"] - AROUND) : x["at"]] if x["left"] else data[x["at"] - 1 : x["at"] + AROUND])
            ids = batch.column("doc_id").take(pa.array(place, pa.int64()))
            yield pa.RecordBatch.from_pydict({"doc_id": ids, "at": pa.array(at, pa.int32()), "left": pa.array(left, pa.bool_()), "around": pa.array(out, pa.binary())})

    found = docs.join(by, "doc_id").mapInArrow(run, f"doc_id {kind}, at int, left boolean, around binary")
    return found.groupBy("doc_id", "at", "left").agg(F.min("around").alias("around"))


def _same(a: bytes, b: bytes) -> int:
    """How many first bytes agree."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    x, y = np.frombuffer(a[:n], np.uint8), np.frombuffer(b[:n], np.uint8)
    return int(np.argmax(x != y))


def _word_starts(data: bytes, skip: int) -> int:
    """Word starts in data after its first `skip` bytes; data begins a text if nothing is skipped."""
    raw = np.frombuffer(b" " * (not skip) + data, np.uint8)
    blank = (raw == 32) | ((raw >= 9) & (raw <= 13))
    return int((~blank[1:] & blank[:-1])[max(0, skip - 1) :].sum())


def extended(runs: DataFrame) -> DataFrame:
    """Runs with the bytes around both ends here (own_left, own_right) and where they are compared (left, right): moved ends, and words."""
    names = [f for f in runs.schema if f.name not in ("own_left", "own_right", "left", "right")]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in names) + ", before int, after int, words bigint"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before, after, words = [], [], []
            for a, b, c, d in zip(*[batch.column(k).to_pylist() for k in ("own_left", "left", "own_right", "right")], strict=True):
                n, m = _same(a[::-1], b[::-1]), max(0, _same(c, d) - 1)
                before.append(n)
                after.append(m)
                # without a byte before it, what was compared begins the text
                words.append(_word_starts(a[len(a) - n - 1 :], 1) if n < len(a) else _word_starts(a, len(a) == AROUND))
                words[-1] += _word_starts(c[: m + 1], 1)
            whole = pa.compute.add(batch.column("n_words"), pa.array(words, pa.int64()))
            cols = [batch.column(f.name) for f in names]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(before, pa.int32()), pa.array(after, pa.int32()), whole], names=[*[f.name for f in names], "before", "after", "words"])

    return runs.mapInArrow(run, schema)


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS) -> DataFrame:
    """Per part of a passage: doc_id, start_byte, end_byte, n_chunks and n_words of the passage, first_doc_id (the smallest that has
    the part's chunks), kept (whether that is this one), passage_start, passage_end."""
    rows = slim(docs, doc_id=id_col, text=text_col).filter("doc_id IS NOT NULL")
    made = materialize(document_chunks(rows).withColumn("row", F.monotonically_increasing_id()), "chunks")  # a row's number is the one written
    begin = F.concat(F.array(F.lit(0)), "stops")
    places = made.select("row", "doc_id", F.posexplode(F.arrays_zip("digests", "words", "stops", F.slice(begin, 1, F.size("stops")).alias("starts"))).alias("k", "c"))
    places = places.select("row", "doc_id", "k", F.col("c.digests").alias("digest"), F.col("c.words").alias("words"), F.col("c.starts").alias("start"), F.col("c.stops").alias("stop"))
    shared = places.groupBy("digest").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.min_by("start", "doc_id").alias("first_at"), F.max_by("start", "doc_id").alias("last_at")).filter("first <> last")
    shared = materialize(shared, "shared")
    hits = places.join(shared, "digest").drop("digest")
    order = Window.partitionBy("row").orderBy("k")
    new = F.coalesce((F.lag("k").over(order) != F.col("k") - 1) | (F.lag("first").over(order) != F.col("first")), F.lit(True))
    hits = hits.withColumn("new", new.cast("int")).withColumn("run", F.col("k") - F.row_number().over(order)).withColumn("part", F.sum("new").over(order))
    ends = [f(c, "k").alias(f"{c}_{n}") for n, f in (("l", F.min_by), ("r", F.max_by)) for c in ("first_at", "last", "last_at")]
    parts = hits.groupBy("row", "doc_id", "run", "part").agg(F.min("first").alias("first"), F.min("start").alias("start"), F.max("stop").alias("stop"), F.max("start").alias("end_chunk"), F.sum("words").alias("w"), F.count("*").alias("n"), *ends)
    listed = F.sort_array(F.collect_list(F.struct("start", "stop", "first", "end_chunk", *[f"{c}_{n}" for n in "lr" for c in ("first_at", "last", "last_at")])))
    runs = parts.groupBy("row", "doc_id", "run").agg(F.sum("w").alias("n_words"), F.sum("n").alias("n_chunks"), listed.alias("parts")).filter(F.col("n_words") >= RUN_WORDS)
    runs = materialize(runs, "runs")
    discard(shared, made)
    p, q = F.element_at("parts", 1), F.element_at("parts", -1)
    elsewhere = [F.when(x["first"] != F.col("doc_id"), F.struct(x["first"].alias("doc_id"), x[f"first_at_{n}"].alias("at"))).otherwise(F.struct(x[f"last_{n}"].alias("doc_id"), x[f"last_at_{n}"].alias("at"))) for x, n in ((p, "l"), (q, "r"))]
    asked = [
        F.struct(F.lit("own_left").alias("role"), F.col("doc_id"), p["start"].alias("at"), F.lit(True).alias("left")),
        F.struct(F.lit("left").alias("role"), elsewhere[0]["doc_id"].alias("doc_id"), elsewhere[0]["at"].alias("at"), F.lit(True).alias("left")),
        F.struct(F.lit("own_right").alias("role"), F.col("doc_id"), q["stop"].alias("at"), F.lit(False).alias("left")),
        F.struct(F.lit("right").alias("role"), elsewhere[1]["doc_id"].alias("doc_id"), (elsewhere[1]["at"] + q["stop"] - q["end_chunk"]).alias("at"), F.lit(False).alias("left")),
    ]
    asked = runs.select("row", "run", F.explode(F.array(*asked)).alias("x")).select("row", "run", "x.*")
    around = asked.join(surroundings(rows, asked.select("doc_id", "at", "left")), ["doc_id", "at", "left"])
    around = around.groupBy("row", "run").agg(*[F.max(F.when(F.col("role") == k, F.col("around"))).alias(k) for k in ("own_left", "left", "own_right", "right")])
    found = extended(runs.join(around, ["row", "run"]).select("doc_id", "n_words", "n_chunks", "parts", "own_left", "left", "own_right", "right")).filter(F.col("words") >= words)
    low, high = F.col("parts")[0]["start"] - F.col("before"), F.element_at("parts", -1)["stop"] + F.col("after")
    out = found.select("doc_id", "n_chunks", F.col("words").alias("n_words"), low.cast("long").alias("passage_start"), high.cast("long").alias("passage_end"), F.size("parts").alias("n"), F.posexplode("parts").alias("i", "part"))
    start = F.when(F.col("i") == 0, F.col("passage_start")).otherwise(F.col("part.start"))
    end = F.when(F.col("i") == F.col("n") - 1, F.col("passage_end")).otherwise(F.col("part.stop"))
    return out.select("doc_id", start.cast("long").alias("start_byte"), end.cast("long").alias("end_byte"), "n_chunks", "n_words", F.col("part.first").alias("first_doc_id"), (F.col("part.first") == F.col("doc_id")).alias("kept"), "passage_start", "passage_end")
