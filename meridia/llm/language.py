"""Operator 7: language identification by averaged hashed subword embeddings and a linear softmax.

A text's letters, lower-cased, give subwords of one to four signs, each hashed into one of 2**BITS rows of an embedding table.
The mean of a text's rows goes through a linear layer to a softmax over the languages seen in training and one more class, of
what is none of them. Both are trained by stochastic gradient descent in numpy, on the driver, on a sample of labelled texts:
PER_LANGUAGE of each language, or SAMPLE / languages where that is less, but LEAST_TEXTS at least. Each gives a short piece
of its own too, and a piece whose letters are exchanged or shuffled, for the further class. Spark computes the features, from
whole texts, and sends bucket numbers and shares.

A fifth of the texts is set aside to fit the softmax's temperature and, for texts of few, some and many subwords, the chance of
being in a learned language below which a text is rejected: at most LEAST_SHARE of the texts, pieces and mixtures set aside fall below
it, with a margin of MARGIN in the odds. The score is the chance of the language named. Prediction reads every row's whole text in
its partition, without a shuffle.

Defined cases: a null text or one without letters is `und` with score 0 and is rejected; rows with a null id are predicted but
never learned from and aren't held out; without labelled texts all is `und`; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import LETTER, char_classes, chunks
from .common import discard, materialize, slim

BITS = 15
DIM = 16
PER_LANGUAGE = 400
SAMPLE = 8000
LEAST_TEXTS = 20
EPOCHS = 8
RATE = 20.0
LEAST_SHARE = 0.002
MARGIN = 10.0
FEW = (30, 150)  # where a text's number of subwords becomes some, and many
PIECE_WORDS = 120
SCRIPTS = ("abcdefghijklmnopqrstuvwxyz", "abcdefghijklmnopqrstuvwxyzßàáâäåæçèéêëíîïñóôöøùúûü", "αβγδεζηθικλμνξοπρστυφχψω", "абвгдежзийклмнопрстуфхцчшщыьэюя", "אבגדהוזחטיכלמנסעפצקרשת", "ابتثجحخدذرزسشصضطظعغفقكلمنهوي")
SALTS = 32
PER_SALT = 64  # of a language's rows with one salt, in the first of two rounds of choosing; five times what is needed on average


def subwords(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each subword length: buckets of all subwords of all texts, and the end of each text's share."""
    low = [t.lower() for t in texts]
    joined = "\n" + "\n".join(low) + "\n"  # a text begins with the sign before it, so that no window reaches into the next
    points = np.frombuffer(joined.encode("utf-32-le"), np.uint32)
    letter = char_classes()[points] == LETTER
    stops = np.cumsum([len(t) + 1 for t in low])
    sign = np.where(letter, points, 0).astype(np.uint64)
    sign = (sign + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    out = []
    n = len(points)
    h = np.zeros(n, np.uint64)
    for k in range(1, 5):
        if n < k:
            break
        h = (h[: n - k + 1] ^ (h[: n - k + 1] >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9) + sign[k - 1 :]
        ok = letter.copy() if k == 1 else letter[: n - k + 1] | letter[1 : n - k + 2] if k == 2 else letter[1 : n - k + 2].copy()
        for j in range(2, k - 1):
            ok &= letter[j : j + n - k + 1]
        at = np.flatnonzero(ok)
        code = ((h[at] ^ (h[at] >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)) >> np.uint64(64 - BITS)
        out.append((code.astype(np.int64), np.searchsorted(at, stops)))
    return out


def features(texts: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The distinct buckets of each text and how many of its subwords are in each."""
    parts = subwords(texts)
    return [np.unique(np.concatenate([c[e[i - 1] if i else 0 : e[i]] for c, e in parts]), return_counts=True) for i in range(len(texts))]


def short_piece(text: str, rng: np.random.Generator, most: int = 8) -> str:
    """One to `most` words of a text."""
    words = text.split()
    n = int(rng.integers(1, most + 1))
    at = int(rng.integers(0, max(1, len(words) - n + 1)))
    return " ".join(words[at : at + n])


def disguised(text: str, rng: np.random.Generator) -> str:
    """A piece of a text in no language: its letters exchanged for those of a script, or shuffled."""
    words = text.lower().split()
    at = int(rng.integers(0, max(1, len(words) - PIECE_WORDS + 1)))
    piece = " ".join(words[at : at + int(rng.integers(2, PIECE_WORDS + 1))])
    own = [c for c in piece if c.isalpha()]
    if rng.random() < 0.4:
        mixed = iter(rng.permutation(own).tolist())
        return "".join([next(mixed) if c.isalpha() else c for c in piece])
    letters = list(SCRIPTS[int(rng.integers(len(SCRIPTS)))])
    change = {c: letters[int(rng.integers(len(letters)))] for c in sorted(set(own))}
    return "".join([change.get(c, c) for c in piece])


@dataclass
class Model:
    """What a prediction needs: each bucket's share in the logit of each language and of the further class, bias, temperature, and,
    for texts of few, some and many subwords, the least chance of being in a learned language that is accepted."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: tuple[float, ...] = (0.0, 0.0, 0.0)

    def logits(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(texts, languages and the further class), and the subwords of each text."""
        width = self.table.shape[1]
        total, count = np.zeros((len(texts), width)), np.zeros(len(texts), np.int64)
        for code, ends in subwords(texts):
            count += np.diff(ends, prepend=0)
            for j in range(width):
                run = np.concatenate(([0.0], np.cumsum(self.table[code, j])))
                total[:, j] += np.diff(run[ends], prepend=0.0)
        return total / np.maximum(count, 1)[:, None] + self.bias, count

    def predict(self, texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, calibrated score and whether it is rejected, of each text."""
        if not self.languages:
            return ["und"] * len(texts), np.zeros(len(texts)), np.ones(len(texts), bool)
        z, count = self.logits(texts)
        p = softmax(z / self.temperature)
        best, some = p[:, :-1].argmax(1), count > 0
        no = ~some | (1 - p[:, -1] < np.array(self.least)[np.searchsorted(FEW, count, "right")])
        return [self.languages[k] if s else "und" for k, s in zip(best, some, strict=True)], np.where(some, p[:, :-1].max(1), 0.0), no


def softmax(z: np.ndarray) -> np.ndarray:
    """Row-wise."""
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(rows: list[tuple[str | None, int, np.ndarray, np.ndarray]], epochs: int = EPOCHS, seed: int = 3) -> Model:
    """rows: (language or null for none, number of its text, buckets, counts). All rows of a text are learned from, or none."""
    languages = sorted({r[0] for r in rows if r[0] is not None})
    rng = np.random.default_rng(seed)
    y = np.array([len(languages) if r[0] is None else languages.index(r[0]) for r in rows])
    text = np.array([r[1] for r in rows])
    count = np.array([int(r[3].sum()) for r in rows])
    share = [r[3] / r[3].sum() for r in rows]
    texts = rng.permutation(np.unique(text))
    aside = np.isin(text, texts[: len(texts) // 5] if len(texts) >= 20 else texts[:0])
    learn = np.flatnonzero(~aside)
    emb = rng.normal(0, 0.1, (1 << BITS, DIM))
    out, bias = rng.normal(0, 0.3, (DIM, len(languages) + 1)), np.zeros(len(languages) + 1)
    steps, done = epochs * len(learn), 0
    for _ in range(epochs):
        for i in rng.permutation(learn):
            at = rows[i][2]
            rate = RATE * (1 - done / steps)
            done += 1
            x = share[i] @ emb[at]
            g = softmax(x @ out + bias)
            g[y[i]] -= 1
            back = out @ g
            out -= 0.05 * rate * np.outer(x, g)
            bias -= 0.002 * rate * g
            emb[at] -= rate * share[i][:, None] * back
    model = Model(languages, (emb @ out).astype(np.float32), bias)
    held = np.flatnonzero(aside) if aside.any() else learn
    z = np.stack([share[i] @ model.table[rows[i][2]] + bias for i in held])
    grid = np.geomspace(0.05, 1000, 100)
    cost = [-np.log(softmax(z / t)[np.arange(len(held)), y[held]] + 1e-12).mean() for t in grid]
    model.temperature = float(max(0.05, grid[int(np.argmin(cost))]))
    real = y[held] < len(languages)
    # a mixture is what two texts set aside give together: the mean of their logits
    pair = rng.permutation(np.flatnonzero(real))
    z = np.concatenate((z[real], (z[pair[:-1]] + z[pair[1:]]) / 2))
    n = np.concatenate((count[held][real], np.minimum(count[held][pair[:-1]], count[held][pair[1:]])))
    known = 1 - softmax(z / model.temperature)[:, -1]
    size = np.searchsorted(FEW, n, "right")
    least = []
    for k in range(len(FEW) + 1):
        own = known[size == k] if (size == k).any() else known
        q = float(np.quantile(own, LEAST_SHARE))
        least.append(q / (q + (1 - q) * MARGIN))
    model.least = tuple(least)
    return model


def learned(docs: DataFrame) -> Model:
    """A model from docs(doc_id, text, lang), without the rows held out."""
    none = Model([], np.zeros((1 << BITS, 0)), np.zeros(0))
    labelled = docs.filter("lang IS NOT NULL AND doc_id IS NOT NULL AND NOT held_out").select("doc_id", "lang")
    languages = labelled.select("lang").distinct().count()
    if not languages:
        return none
    most = max(LEAST_TEXTS, min(PER_LANGUAGE, SAMPLE // languages))
    rank = F.xxhash64(F.lit(29), "doc_id")
    salted = labelled.withColumn("salt", F.pmod(F.xxhash64("doc_id"), F.lit(SALTS)))
    few = salted.withColumn("r", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(rank, "doc_id"))).filter(F.col("r") <= PER_SALT)
    few = few.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy(rank, "doc_id"))).filter(F.col("r") <= most)
    sample = materialize(few.select("doc_id", "lang"), "sample")
    chosen = F.broadcast(sample.select(F.col("doc_id").alias("own")).distinct())  # at most SAMPLE ids, or LEAST_TEXTS a language
    texts = docs.filter("text IS NOT NULL AND lang IS NOT NULL AND NOT held_out").join(chosen, F.col("doc_id") == F.col("own"), "left_semi").select("doc_id", "lang", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 500_000):
            cols: dict[str, list] = {k: [] for k in ("doc_id", "lang", "at", "n")}
            whole = batch.column("text").to_pylist()
            ids, langs = (batch.column(k).to_pylist() for k in ("doc_id", "lang"))
            rngs = [np.random.default_rng(zlib.crc32(str(i).encode())) for i in ids]
            forms = [whole, [short_piece(t, r) for t, r in zip(whole, rngs, strict=True)], [disguised(t, r) for t, r in zip(whole, rngs, strict=True)]]
            for form, rows in enumerate(map(features, forms)):
                for i, lang, (at, n) in zip(ids, langs, rows, strict=True):
                    if len(at):
                        cols["doc_id"].append(i)
                        cols["lang"].append(None if form == 2 else lang)
                        cols["at"].append(at.astype("<u2").tobytes())
                        cols["n"].append(n.astype("<u4").tobytes())
            types = {"doc_id": batch.schema.field("doc_id").type, "lang": pa.string(), "at": pa.binary(), "n": pa.binary()}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, types[k]) for k, v in cols.items()})

    kind = docs.schema["doc_id"].dataType.simpleString()
    got = texts.mapInArrow(run, f"doc_id {kind}, lang string, at binary, n binary").toArrow()  # of the sample
    got = got.sort_by([("doc_id", "ascending"), ("lang", "ascending"), ("at", "ascending")])
    number = {x: k for k, x in enumerate(dict.fromkeys(got.column("doc_id").to_pylist()))}
    rows = [(r["lang"], number[r["doc_id"]], np.frombuffer(r["at"], "<u2").astype(np.int64), np.frombuffer(r["n"], "<u4").astype(np.float64)) for r in got.to_pylist()]
    discard(sample)
    return train(rows) if any(r[0] is not None for r in rows) else none


def with_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Per row: doc_id, held_out, lang_pred, score, rejected."""
    rows = slim(docs, doc_id=id_col, text=text_col, lang=lang_col)
    held = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))
    rows = rows.withColumn("held_out", held)
    model = learned(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, "text", 1_000_000):
            langs, scores, no = model.predict([t or "" for t in batch.column("text").to_pylist()])
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out"), "lang_pred": pa.array(langs, pa.string()), "score": pa.array(scores, pa.float64()), "rejected": pa.array(no)})

    kind = docs.schema[id_col].dataType.simpleString()
    return rows.select("doc_id", "held_out", "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, lang_pred string, score double, rejected boolean")


def accepted(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The rows of docs whose language isn't rejected, with their own columns."""
    rows = slim(docs, doc_id=id_col, text=text_col, lang=lang_col)
    model = learned(rows.withColumn("held_out", F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chunks(batches, text_col, 1_000_000):
            no = model.predict([t or "" for t in batch.column(text_col).to_pylist()])[2]
            yield batch.filter(pa.array(~no))

    return docs.mapInArrow(run, docs.schema)
