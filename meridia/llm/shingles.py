"""Operator 5: near-dedup of texts by a chosen-path set similarity join (minwise tokens).

A document's set is that of its distinct 5-word shingles. Equal sets are one class throughout. Each class descends TREES
independent trees: at every node it branches along two minwise tokens chosen by the node, and classes that share a token meet
in the child. Nodes of at most NODE_SETS classes and NODE_SHINGLES shingles are compared exhaustively; larger ones branch
again, up to LEVELS times. What is still larger then is cut into blocks of which each meets each other one. A pair at the
threshold survives a tree with a chance of 0.89 at least, so six trees miss it with a chance below 2e-6.

Within a node, pairs whose minwise sketches agree in fewer than SKETCH_LEAST places are set aside (missed: below 1e-5), and
pairs already in one cluster aren't compared again; every link is confirmed on the full sets, held as 64-bit hashes of the
shingles. Nodes return spanning links, never all pairs.

Defined cases: null text is empty; documents without words have an empty set, link with nothing and stay; documents with
fewer words than a shingle have their whole word sequence as one; rows that repeat an id are one node, also with different texts,
which it then links, and stay or go together; rows with a null id follow their set's class and stay; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import chunks
from .common import bloom_filter, connected_components, discard, materialize, may_hold, slim

WORDS = 5
PERCENT = 75
TREES = 6
LEVELS = 3
SIGNATURE = 64
SKETCH_LEAST = 30
NODE_SETS = 2048
NODE_SHINGLES = 4_000_000
LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_MASK = 2**64 - 1


class WordHashes(dict):
    """The 64-bit hash of a word, computed at its first sight."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 500_000:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit values."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, words: WordHashes, k: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of a text's k-word shingles."""
    parts = (text or "").encode().translate(LOWER).split()  # bytes.split() parts at U+0020 and U+0009 to U+000D
    if not parts:
        return np.zeros(0, np.uint64)
    w = np.array([words[p] for p in parts], np.uint64)
    n = max(1, len(w) - k + 1)
    h = np.full(n, min(k, len(w)), np.uint64)
    for i in range(min(k, len(w))):
        h = mixed(h * np.uint64(0x9E3779B97F4A7C15) + w[i : i + n])
    return np.unique(h)


def signatures(sets: list[np.ndarray], size: int = SIGNATURE) -> np.ndarray:
    """Minwise values (low 31 bits) of each set under `size` functions; -1 for an empty set."""
    out = np.full((len(sets), size), -1, np.int32)
    full = [i for i, s in enumerate(sets) if len(s)]
    if full:
        flat = np.concatenate([sets[i] for i in full])
        at = np.concatenate(([0], np.cumsum([len(sets[i]) for i in full])[:-1]))
        rng = np.random.default_rng(11)
        for j, m in enumerate(rng.integers(0, 2**63, size, np.uint64) | np.uint64(1)):
            h = flat * m
            h ^= h >> np.uint64(29)
            h *= np.uint64(0xBF58476D1CE4E5B9)
            out[full, j] = (np.minimum.reduceat(h, at) >> np.uint64(33)).astype(np.int32)
    return out


def _int_lists(values: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(np.arange(0, values.size + 1, values.shape[1], np.int32), values.ravel())


def document_signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, set_key, sig) for docs(doc_id, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in chunks(batches, "text", 2_000_000):
            sets = [shingle_set(t, words) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch.column("doc_id"),
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "set_key": pa.array([hashlib.md5(s.tobytes()).digest() for s in sets], pa.binary()),
                    "sig": _int_lists(signatures(sets)),
                }
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(run, f"doc_id {kind}, n_shingles bigint, set_key binary, sig array<int>")


def document_sets(docs: DataFrame) -> DataFrame:
    """(set_key, shingles) for docs(text): the sorted hashes, eight bytes each, and their digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = WordHashes()
        for batch in chunks(batches, "text", 2_000_000):
            sets = [shingle_set(t, words).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_pydict({"set_key": pa.array([hashlib.md5(x).digest() for x in sets], pa.binary()), "shingles": pa.array(sets, pa.binary())})

    return docs.select("text").mapInArrow(run, "set_key binary, shingles binary")


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether 100 * intersection size >= PERCENT * union size, for sorted distinct arrays."""
    if min(len(a), len(b)) * 100 < PERCENT * max(len(a), len(b)):
        return False
    both = np.concatenate((a, b))
    both.sort(kind="stable")
    same = int((both[1:] == both[:-1]).sum())
    return 100 * same >= PERCENT * (len(a) + len(b) - same)


def sketch_groups(ids: np.ndarray, sizes: np.ndarray, sigs: np.ndarray) -> list[np.ndarray]:
    """Rows of a node in groups that its sketches may link; rows without a possible partner are in none."""
    group = np.full(len(ids), -1)
    out = []
    for i in range(len(ids)):
        if group[i] >= 0:
            continue
        group[i] = len(out)
        front, members = [i], [i]
        while front:
            k = front.pop()
            open_ = np.flatnonzero(group < 0)
            if not len(open_):
                break
            near = (np.minimum(sizes[open_], sizes[k]) * 100 >= PERCENT * np.maximum(sizes[open_], sizes[k])) & ((sigs[open_] == sigs[k]).sum(1) >= SKETCH_LEAST)
            new = open_[near]
            group[new] = len(out)
            members += new.tolist()
            front += new.tolist()
        out.append(np.array(sorted(members)))
    return [m for m in out if len(m) > 1]


class Postings:
    """Which rows of a node hold each shingle, to count a row's common shingles with all others at once."""

    def __init__(self, sets: list[np.ndarray]):
        sizes = np.array([len(s) for s in sets])
        _, self.token = np.unique(np.concatenate(sets), return_inverse=True)
        self.stop = np.cumsum(sizes)
        self.row = np.repeat(np.arange(len(sets)), sizes)[np.argsort(self.token, kind="stable")]
        self.count = np.bincount(self.token)
        self.first = np.cumsum(self.count) - self.count
        self.rows = len(sets)

    def common(self, i: int) -> np.ndarray:
        """Common shingles of row i with every row."""
        token = self.token[self.stop[i - 1] if i else 0 : self.stop[i]]
        n = self.count[token]
        at = np.repeat(self.first[token] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        return np.bincount(self.row[at], minlength=self.rows)


def spanning_links(ids: np.ndarray, sets: list[np.ndarray], sigs: np.ndarray) -> list[tuple[int, int]]:
    """Links that span each cluster of the rows; pairs in one cluster already aren't compared."""
    n = len(ids)
    label = np.arange(n)
    sizes = np.array([len(s) for s in sets])
    postings: Postings | None = None
    out = []
    for i in range(n):
        open_ = i + 1 + np.flatnonzero(label[i + 1 :] != label[i])
        fit = np.minimum(sizes[open_], sizes[i]) * 100 >= PERCENT * np.maximum(sizes[open_], sizes[i])
        open_ = open_[fit]
        near = open_[(sigs[open_] == sigs[i]).sum(1) >= SKETCH_LEAST]
        if len(near) > 8:
            postings = postings or Postings(sets)
            same = postings.common(i)[near]
            near = near[100 * same >= PERCENT * (sizes[near] + sizes[i] - same)]
        else:
            near = [j for j in near.tolist() if linked(sets[i], sets[j])]
        for j in map(int, near):
            if label[j] != label[i]:
                out.append((int(ids[i]), int(ids[j])))
                label[label == label[j]] = label[i]
    return out


def _nodes(classes: DataFrame) -> DataFrame:
    """(path, id, n) for the members of all nodes that are compared exhaustively."""
    roots = 2 * TREES
    slim_sigs = classes.select("id", "n", "sig")
    level = slim_sigs.select("id", "n", F.posexplode(F.slice("sig", 1, roots)).alias("i", "token")).select(F.xxhash64("i", "token").alias("path"), "id", "n")
    done = []
    for depth in range(LEVELS):
        level = materialize(level, "paths")
        sizes = level.groupBy("path").agg(F.count("*").alias("members"), F.sum("n").alias("weight")).filter("members > 1")
        fits = (F.col("members") == 2) | ((F.col("members") <= NODE_SETS) & (F.col("weight") <= NODE_SHINGLES))
        sizes = materialize(sizes.withColumn("fits", fits), "sizes")
        done.append(level.join(sizes.filter("fits"), "path").select("path", "id", "n"))
        large = sizes.filter("NOT fits")
        if large.limit(1).count() == 0:
            break
        wide = level.join(large, "path").select("path", "id", "n", "members", "weight")
        if depth == LEVELS - 1:  # the exact way for the rest: each block with each other one
            blocks = F.greatest(F.ceil(F.col("members") * 2 / NODE_SETS), F.ceil(F.col("weight") * 2 / NODE_SHINGLES)).cast("int")
            wide = wide.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("id", F.lit(3)), F.col("blocks")).cast("int"))
            pairs = wide.select("path", "id", "n", "block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
            done.append(pairs.select(F.xxhash64("path", F.least("block", "other"), F.greatest("block", "other")).alias("path"), "id", "n"))
        else:
            chosen = [roots + F.pmod(F.shiftright("path", 8 * k), F.lit(SIGNATURE - roots)) for k in range(2)]
            tokens = F.array(*[F.xxhash64("path", c, F.element_at("sig", (c + 1).cast("int"))) for c in chosen])
            level = wide.join(slim_sigs.select("id", "sig"), "id").select(F.explode(F.array_distinct(tokens)).alias("path"), "id", "n")
    out = done[0]
    for x in done[1:]:
        out = out.unionByName(x)
    return out


def _distinct_groups(members: DataFrame) -> DataFrame:
    """(g, id): groups(path, id) without those that have the same members as another."""
    sums = members.groupBy("path").agg(F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("s1"), F.sum(F.xxhash64(F.lit(7), "id").cast("decimal(38,0)")).alias("s2"), F.count("*").alias("c"))
    one = sums.filter("c > 1").groupBy("s1", "s2", "c").agg(F.min("path").alias("path"))
    return members.join(one.select("path"), "path").select(F.col("path").alias("g"), "id")


def _sketched(group: pa.Table) -> pa.Table:
    ids = group.column("id").to_numpy()
    sigs = group.column("sig").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    found = sketch_groups(ids, group.column("n").to_numpy(), sigs)
    names, members = [], []
    for m in found:
        own = np.sort(ids[m])
        names += [xxhash.xxh3_64_intdigest(own.tobytes()) - 2**63] * len(own)
        members += own.tolist()
    return pa.table({"path": pa.array(names, pa.int64()), "id": pa.array(members, pa.int64())})


def _confirmed(group: pa.Table) -> pa.Table:
    group = group.sort_by("id")
    ids = group.column("id").to_numpy()
    sets = [np.frombuffer(x.as_py(), np.uint64) for x in group.column("shingles")]
    sigs = group.column("sig").combine_chunks().flatten().to_numpy().reshape(len(ids), -1)
    found = spanning_links(ids, sets, sigs)
    return pa.table({"a": pa.array([a for a, _ in found], pa.int64()), "b": pa.array([b for _, b in found], pa.int64())})


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_shingles, component_id, kept."""
    rows = slim(docs, doc_id=id_col, text=text_col)
    signed = materialize(document_signatures(rows), "signed")
    found = signed.filter("n_shingles > 0").groupBy("set_key").agg(F.min("doc_id").cast("long").alias("least"), F.first("n_shingles").alias("n"), F.first("sig").alias("sig"))
    found = materialize(found.withColumn("id", F.monotonically_increasing_id()), "classes")  # a class's number is the one written
    members = signed.select("doc_id", "n_shingles", "set_key").join(found.select("set_key", "id"), "set_key", "left")
    members = materialize(members.select("doc_id", "n_shingles", "id"), "members")
    classes = found.filter("least IS NOT NULL")
    groups = _distinct_groups(_nodes(classes)).join(classes.select("id", "n", "sig"), "id")
    sketched = materialize(groups.groupBy("g").applyInArrow(_sketched, "path bigint, id bigint").distinct(), "sketched")
    wanted = materialize(sketched.select("id").distinct().join(classes.select("id", "least"), "id").select("least").distinct(), "wanted")
    # Most texts and classes are in no group: a filter by their ids leaves them where they are. What it lets pass beside finds no partner below.
    marks = bloom_filter(wanted, "least")
    sets = document_sets(may_hold(rows, F.col("doc_id"), marks)).dropDuplicates(["set_key"])
    grouped = may_hold(classes.select("id", "least", "set_key", "sig"), F.col("least"), marks).drop("least")
    full = sketched.join(grouped, "id").join(sets, "set_key").drop("set_key")
    links = materialize(full.groupBy("path").applyInArrow(_confirmed, "a bigint, b bigint"), "links")
    # an id that repeats with other texts is one node: it joins its classes
    own = members.filter("doc_id IS NOT NULL AND id IS NOT NULL")
    torn = own.groupBy("doc_id").agg(F.min("id").alias("b"), F.max("id").alias("last")).filter("b < last").drop("last")
    joins = own.join(torn, "doc_id").filter("id <> b").select(F.col("id").alias("a"), "b")
    parts = materialize(connected_components(links.union(joins)), "parts")
    discard(sketched, links, signed, wanted)
    known = found.select("id", "least").join(parts, F.col("id") == F.col("node"), "left").drop("node")
    least = known.filter("component IS NOT NULL").groupBy("component").agg(F.min("least").alias("all"))
    named = known.join(least, "component", "left").select("id", F.coalesce("all", "least").alias("component"))
    out = members.join(named, "id", "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc_id"))
    return out.select("doc_id", "n_shingles", component.cast("long").alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of docs that stay, one of each component, with their own columns."""
    gone = near_groups(docs, id_col, text_col).filter("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs[id_col] == gone["__gone"], "left_anti")
