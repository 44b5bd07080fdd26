"""Operator 12: what each of five filters removes in every order that they can be applied in, by source.

A text fails A with under 200 words, B with fewer distinct words than half its words, C with more than 2 % of A-Z, D with one of
`#$%&*|`, and E where a smaller doc_id has the same text anywhere in the table. What a filter does in an order follows from how many
documents fail each set of filters, so only those counts are gathered: 32 sets by the two labels and the part.

Method: texts go to partitions by their xxhash. There each fingerprint has a chain of the different texts that share it, each
with its smallest id, and every other id is given out as one that fails E. The same chains run before the shuffle over the rows of
a task, in blocks of bounded bytes, so a text moves once a block whatever its copies; the copies already known to have a smaller twin
move without it, by their ids. After the shuffle rows come sorted by fingerprint and id (Spark spills them), so only one fingerprint's
chain is held at a time; the number of partitions follows the measured bytes of texts. Count vectors are merged by combineByKey, first within tasks, so a hot source is one vector a task.

Defined cases: null text is empty, null source the empty string; a null id is larger and smaller than none, so E never fails it nor through
it; rows that repeat an id and a text don't fail E by each other; labels that repeat an id count as 1 where any of them is 1; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import permutations

import xxhash
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import slim

FILTERS = "ABCDE"
SAME = 1 << FILTERS.index("E")
#: Bytes of texts that a task holds before its shuffle, and that a partition gets in the mean after it.
BLOCK = 32 << 20
PARTITION = 64 << 20
UPPER = bytes(range(0x41, 0x5B))
SIGNS = b"#$%&*|"

#: A document on its way: key (fingerprint, id or None), and (text or None where E is settled, {part: rows}, filters failed).
Routed = tuple[tuple[int, object], tuple[bytes | None, dict[str, int], int]]


def failures(text: str, raw: bytes) -> int:
    """The set of filters A to D that a text fails, as bits; raw is the text in UTF-8."""
    words = raw.split()
    n = len(words)
    failed = n < 200, 100 * len(set(words)) < 50 * n, 100 * (len(raw) - len(raw.translate(None, UPPER))) > 2 * len(text), len(raw) != len(raw.translate(None, SIGNS))
    return sum(f << i for i, f in enumerate(failed))


def chained(rows: Iterator, block: int = BLOCK) -> Iterator[Routed]:
    """Rows (doc_id, part, text) of a task, routed: per block and text its smallest id with the text, all others without."""
    chains: dict[int, list[list]] = {}
    held = 0

    def settled(own: object, parts: dict[str, int], mask: int, spread: object = None) -> Routed:
        return (xxhash.xxh64_intdigest(f"{own} {spread}"), own), (None, parts, mask)

    def given() -> Iterator[Routed]:
        for key, chain in chains.items():
            for text, least, parts, mask in chain:
                yield (key, least), (text, dict(parts), mask)
        chains.clear()

    for at, (own, part, text) in enumerate(rows):
        raw = text.encode("utf-8", "surrogatepass")
        key = xxhash.xxh64_intdigest(raw)
        link = next((x for x in chains.get(key, ()) if x[0] == raw), None)
        if own is None:
            yield settled(None, {part: 1}, failures(text, raw) if link is None else link[3], (at, part))
        elif link is None:
            chains.setdefault(key, []).append([raw, own, Counter({part: 1}), failures(text, raw)])
            held += len(raw) + 200
        elif own == link[1]:
            link[2][part] += 1
        elif own > link[1]:
            yield settled(own, {part: 1}, link[3] | SAME)
        else:
            yield settled(link[1], dict(link[2]), link[3] | SAME)
            link[1], link[2] = own, Counter({part: 1})
        if held > block:
            yield from given()
            held = 0
    yield from given()


def non_minimum(routed: Iterator[Routed]) -> Iterator[tuple]:
    """(doc_id, part, filters failed, rows) of the routed, which come by fingerprint and id; so a text's first id is its smallest."""
    at, chain = None, {}
    for (key, own), (text, parts, mask) in routed:
        if text is not None:
            if key != at:
                at, chain = key, {}
            if own != chain.setdefault(text, own):
                mask |= SAME
        for part, n in parts.items():
            yield own, part, mask, n


def _order(key: tuple) -> tuple:
    return key[0], key[1] is not None, key[1]


def _route(key: tuple) -> int:
    return key[0]


def failed_sets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """(doc_id, part, mask, n): the filters that n equal rows fail, as bits in the order of FILTERS."""
    spark = docs.sparkSession
    rows = slim(docs, doc_id=id_col, part=part_col, text=text_col)
    kind = rows.schema["doc_id"].dataType
    rows = rows.select("doc_id", F.coalesce(F.col("part").cast("string"), F.lit("")).alias("part"), F.coalesce("text", F.lit("")).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    routed: RDD = rows.rdd.mapPartitions(chained)
    width = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION))
    found = routed.repartitionAndSortWithinPartitions(width, _route, True, _order).mapPartitions(non_minimum)
    schema = T.StructType([T.StructField("doc_id", kind), T.StructField("part", T.StringType()), T.StructField("mask", T.IntegerType()), T.StructField("n", T.LongType())])
    return spark.createDataFrame(found, schema, verifySchema=False)


def _put(vector: dict, found: tuple) -> dict:
    at, n = found
    vector[at] = vector.get(at, 0) + n
    return vector


def _merge(one: dict, other: dict) -> dict:
    for at, n in other.items():
        one[at] = one.get(at, 0) + n
    return one


def _steps(found: tuple[str, dict]) -> Iterator[tuple]:
    """The 600 rows of a part, from its rows by (filters failed, good, toxic)."""
    part, vector = found

    def count(keep, at: int = -1) -> int:
        return sum(n for key, n in vector.items() if keep(key[0]) and (at < 0 or key[at]))

    def did(f: int, earlier: int) -> dict:
        here = lambda m: m & f and not m & earlier
        return {
            "kept": count(lambda m: not m & (earlier | f)), "removed": count(here), "redundant": count(lambda m: m & f and m & earlier),
            "unique_fails": count(lambda m: m == f), "good_lost": count(here, 1), "toxic_lost": count(here, 2),
        }

    known: dict[tuple[int, int], dict] = {}
    rows, removed = [], Counter()
    for order in permutations(FILTERS):
        earlier = 0
        for step, name in enumerate(order, 1):
            f = 1 << FILTERS.index(name)
            if (f, earlier) not in known:
                known[f, earlier] = did(f, earlier)
            x = known[f, earlier]
            removed[name] += x["removed"]
            rows.append((part, "".join(order), step, *x.values()))
            earlier |= f
    for r in rows:
        yield *r, removed[r[1][r[2] - 1]]


def filter_audit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source") -> DataFrame:
    """Per part, filter_order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    spark = docs.sparkSession
    marked = slim(labels, own="doc_id", quality="quality", toxic="toxic").filter("own IS NOT NULL").groupBy("own").agg(F.max(F.expr("quality <=> 1")).alias("good"), F.max(F.expr("toxic <=> 1")).alias("toxic"))
    found = failed_sets(docs, id_col, text_col, part_col)
    # Rows without an id have no labels: a key of their own, spread over partitions, keeps them apart in the join.
    found = found.withColumn("own", F.coalesce("doc_id", F.monotonically_increasing_id().cast(found.schema["doc_id"].dataType))).withColumn("named", F.col("doc_id").isNotNull())
    joined = found.join(marked.withColumn("named", F.lit(True)), ["own", "named"], "left")
    rows = joined.select("part", "mask", F.coalesce("good", F.lit(False)), F.coalesce("toxic", F.lit(False)), "n").rdd
    vectors = rows.map(lambda r: (r[0], ((r[1], r[2], r[3]), r[4]))).combineByKey(lambda x: _put({}, x), _put, _merge)
    counts = "kept long, removed long, redundant long, unique_fails long, good_lost long, toxic_lost long, shapley long"
    return spark.createDataFrame(vectors.flatMap(_steps), f"part string, filter_order string, step int, {counts}", verifySchema=False)


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws, min(doc_id) OVER (PARTITION BY t) AS least FROM d),
f AS (
  SELECT doc_id, part,
         CASE WHEN len(ws) < 200 THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < 50 * len(ws) THEN 2 ELSE 0 END
         + CASE WHEN 100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) THEN 4 ELSE 0 END
         + CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 8 ELSE 0 END + CASE WHEN doc_id > least THEN 16 ELSE 0 END AS mask
  FROM w),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic FROM labels GROUP BY 1),
c AS (SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY 1, 2),
x(a, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (
  SELECT a.a || b.a || c.a || d.a || e.a AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM x a, x b, x c, x d, x e WHERE a.bit | b.bit | c.bit | d.bit | e.bit = 31),
s AS (SELECT filter_order, step, bits[step] AS own, coalesce(list_sum(bits[1:step - 1]), 0)::BIGINT AS earlier FROM o, range(1, 6) r(step)),
r AS (
  SELECT part, filter_order, step::INTEGER AS step, own, sum(CASE WHEN mask & (earlier | own) = 0 THEN n ELSE 0 END)::BIGINT AS kept,
         sum(CASE WHEN mask & own > 0 AND mask & earlier = 0 THEN n ELSE 0 END)::BIGINT AS removed,
         sum(CASE WHEN mask & own > 0 AND mask & earlier > 0 THEN n ELSE 0 END)::BIGINT AS redundant,
         sum(CASE WHEN mask = own THEN n ELSE 0 END)::BIGINT AS unique_fails,
         sum(CASE WHEN mask & own > 0 AND mask & earlier = 0 THEN good ELSE 0 END)::BIGINT AS good_lost,
         sum(CASE WHEN mask & own > 0 AND mask & earlier = 0 THEN toxic ELSE 0 END)::BIGINT AS toxic_lost
  FROM c, s GROUP BY 1, 2, 3, 4)
SELECT * EXCLUDE (own), sum(removed) OVER (PARTITION BY part, own)::BIGINT AS shapley FROM r
"""
