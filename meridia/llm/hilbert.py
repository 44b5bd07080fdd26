"""Operator 13 [native]: shards cut from a Hilbert curve through several metadata dimensions, for files that many kinds of filter can skip.

Law `rows`: shard s holds the places p of the curve with p * shards div n = s, so counts differ by one at most. The dimensions are
source, language, size and id. The first three are quantised by equal depth over all rows (a value's cell is the share of rows before
it), the id by equal width between the smallest and the largest; null lies in the first cell. Rows are ordered by the index of their
cell on the curve, then text_crc32 (equal texts of a cell are neighbours), doc_id, size and their place in the input.

Only built-in functions run here. The texts are read once, into a slim table; places come from one range shuffle of it by the whole
order, so a hot source, cell, text or id is spread over partitions, and from the counts of the partitions, of which there are a few
thousand at most. The driver sees at most 15 cuts a dimension and one row of bounds.

Defined cases: null text is empty; rows with null or repeated ids are rows of their own, in the order of the input where all else is
equal; fewer rows than shards leave shards empty; an empty table gives an empty result; other columns are ignored, and source and lang
may be missing, as if they were null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialize

SHARDS = 24
BITS = 4
NAMES = ("source", "lang", "size")
ORDER = ("curve_index", "text_crc32", "doc_id", "size")


def _table(n: int) -> list[int]:
    """For n dimensions: at state * 2^n + digit, the next state * 2^n + the step along the curve. A state is a cell's entry corner * n + its direction."""
    size, mask = 1 << n, (1 << n) - 1
    left = lambda x, k: ((x << k % n) | (x >> (n - k % n))) & mask
    gray = lambda x: x ^ (x >> 1)
    step_of = {gray(w): w for w in range(size)}
    ones = lambda x: (~x & (x + 1)).bit_length() - 1  # noqa: E731  trailing
    entry = [0] + [gray(2 * ((w - 1) // 2)) for w in range(1, size)]
    turn = [0] + [ones(w if w % 2 else w - 1) % n for w in range(1, size)]
    out = []
    for state in range(size * n):
        e, d = divmod(state, n)
        for digit in range(size):
            w = step_of[left(digit ^ e, n - (d + 1) % n)]
            out.append((((e ^ left(entry[w], d + 1)) * n + (d + turn[w] + 1) % n) << n) | w)
    return out


def hilbert_index(cells: list[Column], bits: int) -> Column:
    """The place on the Hilbert curve, as a long, of the cell with these coordinates, each an integer of `bits` bits."""
    n = len(cells)
    if n < 2 or n > 6 or n * bits > 62:
        raise ValueError("from 2 to 6 dimensions and up to 62 bits in all")
    table = F.expr(f"array({','.join(map(str, _table(n)))})")
    digits = F.array(*[sum((F.shiftleft(F.shiftright(c.cast("int"), level).bitwiseAND(1), i) for i, c in enumerate(cells)), F.lit(0)) for level in reversed(range(bits))])
    start = F.struct(F.lit(0).alias("state"), F.lit(0).cast("long").alias("index"))

    def walk(at: Column, digit: Column) -> Column:
        found = F.get(table, F.shiftleft(at["state"], n) + digit)
        return F.struct(F.shiftright(found, n).alias("state"), (F.shiftleft(at["index"], n) + found.bitwiseAND((1 << n) - 1)).alias("index"))

    return F.aggregate(digits, start, walk, lambda at: at["index"])


def in_order(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """df in the order given, over all partitions, written to the shared folder, with `part` and `at`: the range partition and the place within it."""
    number = F.monotonically_increasing_id()
    rows = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", number)
    return materialize(rows.withColumn("part", F.shiftright("at", 33)).withColumn("at", F.col("at").bitwiseAND((1 << 33) - 1)), name)


def before_parts(rows: DataFrame, weight: Column) -> DataFrame:
    """(part, before): the sum of the weights of all rows in earlier partitions; a row a partition."""
    sums = rows.groupBy("part").agg(F.sum(weight).alias("w"))
    return sums.select("part", F.coalesce(F.sum("w").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))


def _cuts(rows: DataFrame, total: int, bits: int) -> dict[str, list[tuple[int, str]]]:
    """By dimension: (cell, its smallest value) for cells above 0, in order; at most 2^bits - 1 each. Values are text, sizes with leading zeros."""
    values = F.stack(F.lit(len(NAMES)), *[x for i, c in enumerate(NAMES) for x in (F.lit(i), F.lpad(F.col(c).cast("string"), 20, "0") if c == "size" else F.col(c))]).alias("dim", "value")
    counted = rows.select(values).groupBy("dim", "value").agg(F.count("*").alias("w"))
    placed = in_order(counted, [F.col("dim"), F.col("value").asc_nulls_first()], "shard-values")
    own = F.coalesce(F.sum("w").over(Window.partitionBy("part").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = placed.withColumn("own", own).join(F.broadcast(before_parts(placed, F.col("w"))), "part")
    # Each dimension's weights sum to the number of rows.
    before = F.col("own") + F.col("before") - F.col("dim") * F.lit(total)
    cell = F.floor(before.cast("decimal(38,0)") * (1 << bits) / total).cast("int")
    cuts = placed.withColumn("cell", cell).filter("cell > 0 AND value IS NOT NULL").groupBy("dim", "cell").agg(F.min("value").alias("value"))
    out: dict[str, list[tuple[int, str]]] = {c: [] for c in NAMES}
    for r in sorted(cuts.collect()):
        out[NAMES[r["dim"]]].append((r["cell"], r["value"]))
    return out


def _cell(value: Column, cuts: list[tuple[int, Column]]) -> Column:
    """The cell of the last cut that value reaches, else 0."""
    return F.coalesce(*[F.when(value >= cut, F.lit(cell)) for cell, cut in reversed(cuts)], F.lit(0))


def _facts(docs: DataFrame, id_col: str, text_col: str) -> list[Column]:
    """What the order needs of a row: doc_id, size, text_crc32, source, lang."""
    have = {c.lower() for c in docs.columns}
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    kept = [(F.col(f"`{c}`") if c in have else F.lit(None)).cast("string").alias(c) for c in ("source", "lang")]
    return [F.col(f"`{id_col}`").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), *kept]


def _numbered(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The facts of all rows, written, each with its place in the input."""
    return materialize(docs.select(*_facts(docs, id_col, text_col)).withColumn("nr", F.monotonically_increasing_id()), "shard-rows")


def _curve(rows: DataFrame, bits: int) -> tuple[Column, int]:
    """The index of a row's cell on the curve, and the number of rows."""
    b = rows.agg(F.count("*").alias("n"), F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).first()
    if not b["n"]:
        return F.lit(0).cast("long"), 0
    found = _cuts(rows, b["n"], bits)
    cells = [_cell(F.col(c), [(k, F.lit(int(v)) if c == "size" else F.lit(v)) for k, v in found[c]]) for c in NAMES]
    low, high = int(b["low"] or 0), int(b["high"] or 0)
    number = F.col("doc_id").cast("decimal(20,0)")
    cells.append(F.coalesce(F.floor((number - F.lit(low).cast("decimal(20,0)")) * (1 << bits) / F.lit(high - low + 1).cast("decimal(20,0)")), F.lit(0)))
    return hilbert_index(cells, bits), b["n"]


def _placed(rows: DataFrame, shards: int, index: Column, n: int) -> DataFrame:
    placed = in_order(rows.select("doc_id", "size", "text_crc32", index.alias("curve_index"), "nr"), [F.col(c) for c in (*ORDER, "nr")], "shard-places")
    ranked = placed.join(F.broadcast(before_parts(placed, F.lit(1))), "part").withColumn("place", F.col("before") + F.col("at"))
    ranked = ranked.withColumn("shard", F.expr(f"place * {shards} div {max(n, 1)}"))
    first = F.expr(f"(shard * {n} + {shards - 1}) div {shards}")
    return ranked.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("shard").cast("int").alias("shard"), (F.col("place") - first).alias("slot"), F.lit(None).cast("int").alias("grown_shard"), "curve_index")


def sharded(docs: DataFrame, shards: int = SHARDS, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id (an integer), size, text_crc32, law, shard, slot, grown_shard, and curve_index."""
    rows = _numbered(docs, id_col, text_col)
    return _placed(rows, shards, *_curve(rows, bits))


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, bits: int = BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Writes the rows of docs, whole, to path/shard=<number>/ in the order of the curve, and returns the zone map of the files: per shard its
    rows and the smallest and largest source, lang, size and doc_id. A filter needs only the shards whose zones it meets.

    A row finds its shard by comparison with the first row of each, of which there are `shards`, so texts move once and nothing is
    joined; rows equal in the whole order stay together here. A column of docs named shard is left out."""
    rows = _numbered(docs, id_col, text_col)
    index, n = _curve(rows, bits)
    firsts = _placed(rows, shards, index, n).filter("slot = 0 AND shard > 0").select("shard", *ORDER).orderBy("shard").collect()
    key = lambda at: F.struct(*[at(c).cast("long").alias(c) for c in ORDER])
    shard = _cell(key(F.col), [(r["shard"], key(lambda c, r=r: F.lit(r[c]))) for r in firsts])
    own = [c for c in docs.columns if c.lower() != "shard"]
    whole = docs.select(F.struct(*[f"`{c}`" for c in own]).alias("row"), *_facts(docs, id_col, text_col)).withColumn("curve_index", index)
    whole = whole.withColumn("shard", shard).repartitionByRange("shard", *ORDER).sortWithinPartitions("shard", *ORDER)
    whole.select("row.*", "shard").write.partitionBy("shard").parquet(path)
    written = docs.sparkSession.read.schema(whole.select("row.*", "shard").schema).parquet(path)
    spans = [x for c in ("source", "lang", "size", "doc_id") for x in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"))]
    return written.select("shard", *_facts(written, id_col, text_col)).groupBy("shard").agg(F.count("*").alias("rows"), *spans)


def sql(bits: int = BITS, shards: int = SHARDS) -> str:
    """The same places in SQL: quantiles by windows, the curve level by level with Gray codes, CRC-32 by a fold over bytes."""
    crcs = []
    for x in range(256):
        for _ in range(8):
            x = x >> 1 ^ (0xEDB88320 if x & 1 else 0)
        crcs.append(x)
    right = lambda x, k: f"((({x}) >> ({k})) | (({x}) << (4 - ({k})))) & 15"
    levels, last = [], "cells"
    for level in reversed(range(bits)):
        digit = " + ".join(f"((c{i} >> {level}) & 1) * {1 << i}" for i in range(4))
        levels.append(f"""
a{level} AS (SELECT *, xor({digit}, e) AS x FROM {last}),
b{level} AS (SELECT *, {right("x", "(d + 1) % 4")} AS g FROM a{level}),
w{level} AS (SELECT *, xor(xor(g, g >> 1), xor(g >> 2, g >> 3)) AS w FROM b{level}),
t{level} AS (SELECT *, [0, 0, 0, 3, 3, 6, 6, 5, 5, 12, 12, 15, 15, 10, 10, 9][w + 1] AS entry, [0, 1, 1, 2, 2, 1, 1, 3, 3, 1, 1, 2, 2, 1, 1, 0][w + 1] AS turn FROM w{level}),
s{level} AS (SELECT doc_id, size, text_crc32, n, c0, c1, c2, c3, h * 16 + w AS h, xor(e, {right("entry", "(3 - d) % 4")}) AS e, (d + turn + 1) % 4 AS d FROM t{level}),""")
        last = f"s{level}"
    depth = lambda c: f"CASE WHEN {c} IS NULL THEN 0 ELSE ((rank() OVER (ORDER BY {c} NULLS FIRST) - 1) * {1 << bits} // n)::INT END"
    return f"""
WITH bytes AS (SELECT doc_id, source, lang, coalesce(text, '') AS t, row_number() OVER () AS nr FROM documents),
f AS (
  SELECT doc_id, source, lang, strlen(t) + 8 AS size, count(*) OVER () AS n, min(doc_id) OVER () AS low, max(doc_id) OVER () AS high,
         xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda x: ('0x' || x)::BIGINT)),
             lambda c, x: xor(c >> 8, {crcs}[(xor(c, x) & 255) + 1]::BIGINT))) AS text_crc32
  FROM bytes),
cells AS (
  SELECT doc_id, size, text_crc32, n, 0::BIGINT AS h, 0 AS e, 0 AS d, {depth("source")} AS c0, {depth("lang")} AS c1, {depth("size")} AS c2,
         coalesce(((doc_id - low)::HUGEINT * {1 << bits} // (high - low + 1)::HUGEINT)::INT, 0) AS c3
  FROM f),{"".join(levels)}
p AS (SELECT *, row_number() OVER (ORDER BY h, text_crc32, doc_id NULLS FIRST, size) - 1 AS place FROM {last}),
q AS (SELECT *, place * {shards} // n AS shard FROM p)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'rows' AS law, shard::INTEGER AS shard, (place - (shard * n + {shards - 1}) // {shards})::BIGINT AS slot, NULL::INTEGER AS grown_shard, h AS curve_index
FROM q
"""
