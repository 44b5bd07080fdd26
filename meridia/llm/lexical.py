"""Operator 11: ranked lexical search, score at a time over postings in the order of their impact.

A term is a maximal run of ASCII letters and digits and of all characters beyond ASCII, with A-Z lower-cased. Scores are sums of integers
(see `impacts`), so they don't depend on the order of addition.

Method: the items go in blocks of a bounded size, whose terms are the only ones indexed. One pass over the texts writes each document's
length and its counts of these terms; a second one sums N, L and df. Then each task takes its documents in shards of bounded postings.
A shard's postings of a term stand in groups of equal impact, the largest first. For an item the groups of its terms are
added up from the largest impact down. That stops only when the sum of the next impacts of all terms is below the k-th best score, so that
no document not met yet can be among the first k, and when those that still can be are cheaper to complete than the rest is to
add; these get their whole scores from their own counts. The k-th best is that of the task so far, or that of a first search
over a sixteenth of the documents: a lower bound whatever that part holds, which lets most shards stop early. A task gives k rows an item
at most, and none that the first search rules out, ties by id included.

Defined cases: a document without terms, or with null text, is not counted and not found; null ids rank after all others at equal scores;
rows that repeat an id are documents of their own, as are items; items without terms, or without documents, have no rows; empty
tables give an empty result; other columns are ignored. Ids of documents are integers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize, slim

TOP = 10
#: Items, and bytes of their texts, in a block. A block's terms, weights and thresholds are what tasks get.
BLOCK_ITEMS, BLOCK_BYTES = 4096, 4 << 20
#: Postings of a shard.
POSTINGS = 3 << 20
#: One of so many documents is searched first.
FIRST = 16
#: A-Z to a-z, other letters and digits and bytes beyond ASCII as they are, all else to a blank.
LETTERS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))

Item = tuple[np.ndarray, np.ndarray]


def terms(text: str) -> list[bytes]:
    """The terms of a text in order, in UTF-8."""
    return text.encode("utf-8", "surrogatepass").translate(LETTERS).split()


def counting(vocabulary: dict[bytes, int]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Batches of (doc_id, text) to (doc_id, n, terms, counts) of documents with terms; terms are those of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, lengths, ends, found, counts = [], [], [0], [], []
            for i, text in enumerate(batch.column(1)):
                words = terms(text.as_py() or "")
                if not words:
                    continue
                own = Counter(words)
                for word, n in own.items():
                    at = vocabulary.get(word)
                    if at is not None:
                        found.append(at)
                        counts.append(n)
                keep.append(i)
                lengths.append(len(words))
                ends.append(len(found))
            lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (found, counts)]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(keep, pa.int64())), pa.array(lengths, pa.int64()), *lists], ["doc_id", "n", "terms", "counts"])

    return run


def summing(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counted documents to (term, n): documents with the term, at -1 all documents, at -2 all their terms; a row a task and term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, docs, length = np.zeros(size, np.int64), 0, 0
        for batch in batches:
            docs += batch.num_rows
            length += int(batch.column("n").to_numpy().sum())
            df += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(at, (-1, -2)), pa.int32()), pa.array(np.append(df[at], (docs, length)), pa.int64())], ["term", "n"])

    return run


def weight(docs: int, df: int) -> int:
    """A term's weight: less, the more documents hold it."""
    return math.floor(1000 * math.log((2 * docs + 2) / (2 * df + 1)))


def impacts(w: np.ndarray, tf: np.ndarray, n: np.ndarray, docs: int, length: int) -> np.ndarray:
    """What one occurrence of a term in an item adds to a document's score."""
    m = 100 - 75 + (75 * n * docs) // length
    return w * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


class Shard:
    """Postings of some documents, by document and by term in groups of equal impact."""

    def __init__(self, batches: list[pa.RecordBatch], weights: np.ndarray, docs: int, length: int) -> None:
        whole = pa.Table.from_batches(batches).combine_chunks()
        ids = whole["doc_id"].combine_chunks()
        self.null = np.asarray(ids.is_null())
        self.ids = ids.fill_null(0).to_numpy()
        lists = whole["terms"].combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy())
        self.ends = np.concatenate(([0], np.cumsum(sizes)))
        self.terms = lists.flatten().to_numpy().astype(np.int64)
        tf = whole["counts"].combine_chunks().flatten().to_numpy().astype(np.int64)
        doc = np.repeat(np.arange(len(sizes)), sizes)
        self.impacts = impacts(weights[self.terms], tf, whole["n"].to_numpy()[doc], docs, length)
        order = np.lexsort((-self.impacts, self.terms))
        self.docs, term, impact = doc[order], self.terms[order], self.impacts[order]
        first = np.flatnonzero(np.concatenate(([True], (term[1:] != term[:-1]) | (impact[1:] != impact[:-1])))) if len(term) else np.zeros(0, np.int64)
        # Groups: falling[i] is minus the impact, which rises within a term; its postings are docs[starts[i]:starts[i + 1]].
        self.falling, self.starts = -impact[first], np.append(first, len(term))
        self.of_term = np.searchsorted(term[first], np.arange(len(weights) + 1))

    def complete(self, docs: np.ndarray, share: np.ndarray) -> np.ndarray:
        """Whole scores of documents that hold a term, from their own counts; share has how often the item holds each term."""
        low, sizes = self.ends[docs], self.ends[docs + 1] - self.ends[docs]
        first = np.cumsum(sizes) - sizes
        at = np.repeat(low - first, sizes) + np.arange(sizes.sum())
        return np.add.reduceat(self.impacts[at] * share[self.terms[at]], first) if len(docs) else np.zeros(0, np.int64)

    def search(self, item: Item, share: np.ndarray, least: int, top: int) -> tuple[np.ndarray, np.ndarray]:
        """(documents, whole scores) of all that may be among the first, which have `least` or more; share is zero, and left so."""
        own, times = item
        at, end = self.of_term[own], self.of_term[own + 1]
        live = at < end
        own, times, at, end = own[live], times[live], at[live], end[live]
        score, mean = np.zeros(len(self.ids), np.int64), max(1, len(self.terms) // len(self.ids))
        while True:
            # The next impact of each term bounds what its postings not yet added can add.
            nxt = np.where(at < end, -self.falling[np.minimum(at, end - 1)] * times, 0)
            rest = int(nxt.sum())
            if not rest:
                left = np.flatnonzero(score >= least)
                return left, score[left]
            if len(score) > top and rest < score.max():
                least = max(least, int(np.partition(score, -top)[-top]))
            if rest < least:
                left = np.flatnonzero(score >= least - rest)
                if len(left) * mean <= (self.starts[end] - self.starts[at]).sum():
                    break
            level = max(1, int(nxt.max()) * 2 // 3)
            for j in np.flatnonzero(nxt >= level):
                low, high = at[j], at[j] + np.searchsorted(self.falling[at[j] : end[j]], -(-(-level // times[j])), "right")
                gain = np.repeat(self.falling[low:high], np.diff(self.starts[low : high + 1])) * -times[j]
                score[self.docs[self.starts[low] : self.starts[high]]] += gain
                at[j] = high
        share[own] = times
        whole = self.complete(left, share)
        share[own] = 0
        return left[whole >= least], whole[whole >= least]


def shards(batches: Iterator[pa.RecordBatch], weights: np.ndarray, docs: int, length: int) -> Iterator[Shard]:
    """The documents of a task in shards of bounded postings."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += len(batch.column("terms").flatten())
        if size >= POSTINGS:
            yield Shard(held, weights, docs, length)
            held, size = [], 0
    if held:
        yield Shard(held, weights, docs, length)


def searching(items: list[Item], names: pa.Array, weights: np.ndarray, docs: int, length: int, floors: dict[int, tuple[int, int | None]], top: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counted documents to (item, item_id, doc_id, score): the first `top` of a task for each item, without those ranked after the item's floor (score, doc_id)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        share = np.zeros(len(weights), np.int64)
        best = [(np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)) for _ in items]
        least = [floors[k][0] if k in floors else 1 for k in range(len(items))]
        for shard in shards(batches, weights, docs, length):
            for k, item in enumerate(items):
                found, score = shard.search(item, share, least[k], top)
                if not len(found):
                    continue
                null, ids = shard.null[found], shard.ids[found]
                if k in floors and floors[k][1] is not None:
                    ahead = (score > floors[k][0]) | ~null & (ids <= floors[k][1])
                    score, null, ids = score[ahead], null[ahead], ids[ahead]
                score, null, ids = (np.concatenate(x) for x in zip(best[k], (score, null, ids)))
                order = np.lexsort((ids, null, -score))[:top]
                best[k] = score[order], null[order], ids[order]
                if len(order) == top:
                    least[k] = max(least[k], int(score[order[-1]]))
        item = np.repeat(np.arange(len(items)), [len(b[0]) for b in best])
        score, null, ids = (np.concatenate([b[i] for b in best]) for i in range(3))
        yield pa.RecordBatch.from_arrays([pa.array(item, pa.int32()), names.take(pa.array(item)), pa.array(ids, pa.int64(), mask=null), pa.array(score, pa.int64())], ["item", "item_id", "doc_id", "score"])

    return run


def _blocks(items: DataFrame) -> Iterator[list[tuple[object, list[bytes]]]]:
    """(item_id, terms) of all items with terms, in bounded blocks; the driver holds one of them."""
    block, size = [], 0
    for name, text in items.toLocalIterator():
        words = terms(text or "")
        if words:
            block.append((name, words))
            size += len(text)
        if len(block) >= BLOCK_ITEMS or size >= BLOCK_BYTES:
            yield block
            block, size = [], 0
    if block:
        yield block


def _first(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def _ranked_block(rows: DataFrame, block: list[tuple[object, list[bytes]]], schema: str, names: pa.Array, top: int) -> DataFrame | None:
    vocabulary = {word: at for at, word in enumerate(sorted({w for _, words in block for w in words}))}
    counted = materialize(rows.mapInArrow(counting(vocabulary), "doc_id long, n long, terms array<int>, counts array<int>"), "lexical-counts")
    sums = dict(map(tuple, counted.mapInArrow(summing(len(vocabulary)), "term int, n long").groupBy("term").agg(F.sum("n")).collect()))
    docs, length = sums.pop(-1, 0), sums.pop(-2, 0)
    if not docs:
        return None
    # Terms of no document have no postings; their weight doesn't matter.
    weights = np.array([weight(docs, sums.get(at, 0)) for at in range(len(vocabulary))], np.int64)
    items = []
    for _, words in block:
        own = Counter(vocabulary[w] for w in words)
        items.append((np.array(sorted(own), np.int64), np.array([own[t] for t in sorted(own)], np.int64)))
    part = counted.filter(F.pmod(F.xxhash64("doc_id"), F.lit(FIRST)) == 0)
    early = _first(part.mapInArrow(searching(items, names, weights, docs, length, {}, top), schema), top)
    floors = {r["item"]: (r["score"], r["doc_id"]) for r in early.filter(F.col("rank") == top).select("item", "score", "doc_id").collect()}
    return _first(counted.mapInArrow(searching(items, names, weights, docs, length, floors, top), schema), top)


def ranked(docs: DataFrame, items: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): per item the documents with the highest scores above 0, equal ones by ascending doc_id."""
    from pyspark.sql.pandas.types import to_arrow_type

    asked = slim(items, item_id=item_col, text=item_text_col)
    kind = asked.schema["item_id"].dataType
    schema = f"item int, item_id {kind.simpleString()}, doc_id long, score long"
    rows = slim(docs, doc_id=id_col, text=text_col).withColumn("doc_id", F.col("doc_id").cast("long"))
    found = [_ranked_block(rows, block, schema, pa.array([name for name, _ in block], to_arrow_type(kind)), top) for block in _blocks(asked)]
    found = [x.select("item_id", "rank", "doc_id", "score") for x in found if x is not None]
    if not found:
        return docs.sparkSession.createDataFrame([], f"item_id {kind.simpleString()}, rank int, doc_id long, score long")
    return reduce(DataFrame.unionAll, found)


SQL = r"""
WITH d AS (SELECT row_number() OVER () AS nr, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
k AS (SELECT nr, doc_id, len(ws)::BIGINT AS n, ws FROM d WHERE len(ws) > 0),
a AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS length FROM k),
i AS (
  SELECT item, item_id, term, count(*)::BIGINT AS times
  FROM (SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
  GROUP BY 1, 2, 3),
p AS (SELECT nr, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT nr, doc_id, n, unnest(ws) AS term FROM k) GROUP BY 1, 2, 3, 4),
w AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, a GROUP BY term, docs),
s AS (
  SELECT item, item_id, nr, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length))))::BIGINT AS score
  FROM i JOIN p USING (term) JOIN w USING (term), a GROUP BY 1, 2, 3, 4),
r AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM r WHERE rank <= 10
"""
