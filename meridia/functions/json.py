"""JSON functions over Columns; open payloads are VARIANT."""

import json
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import ColumnLike, _c


def at_path(x: ColumnLike, path: str, kind: str = "string") -> Column:
    """The value at a dotted path with list indexes (`a.b[0].c`), null where there is none or where the text is no JSON."""
    v = F.try_parse_json(_c(x))
    return F.try_variant_get(v, "$." + path if path else "$", kind)


def strict(x: ColumnLike) -> Column:
    """A VARIANT; raises on malformed JSON and on repeated names."""
    return F.parse_json(_c(x))


def well_formed(x: ColumnLike) -> Column:
    """Whether a text is JSON without repeated names."""
    return F.try_parse_json(_c(x)).isNotNull()


def records(x: ColumnLike, keys: tuple[str, ...] = ("data", "results", "items", "records", "hits")) -> Column:
    """The record list of a payload as array<variant>: the root if it is a list, else the first known key, else what _embedded holds, else the object alone."""
    v = F.try_parse_json(_c(x))
    found = [F.try_variant_get(v, "$", "array<variant>")] + [F.try_variant_get(v, f"$.{k}", "array<variant>") for k in keys]
    embedded = F.element_at(F.map_values(F.try_variant_get(v, "$._embedded", "map<string, array<variant>>")), 1)
    return F.coalesce(*found, embedded, F.array(v))


def pointer(x: ColumnLike) -> Column:
    """A name escaped for a JSON pointer."""
    return F.replace(F.replace(_c(x), F.lit("~"), F.lit("~0")), F.lit("/"), F.lit("~1"))


def positional(*lists: ColumnLike, sep: str = ";") -> Column:
    """Separated lists zipped by place: array of struct(f0, f1, ...)."""
    return F.arrays_zip(*[F.split(_c(x), sep).alias(f"f{i}") for i, x in enumerate(lists)])


def canonical_sha256(fields: dict[str, ColumnLike]) -> Column:
    """sha256 of the fields as a JSON object with sorted names."""
    return F.sha2(F.to_json(F.struct(*[_c(fields[k]).alias(k) for k in sorted(fields)])), 256)


def list_response(x: ColumnLike) -> Column:
    """Records of a positional response [total, ids, extra, rows]: array of struct(total, id, row)."""
    v = F.try_parse_json(_c(x))
    total = F.try_variant_get(v, "$[0]", "bigint")
    ids = F.try_variant_get(v, "$[1]", "array<string>")
    rows = F.try_variant_get(v, "$[3]", "array<array<string>>")
    return F.zip_with(ids, rows, lambda i, r: F.struct(total.alias("total"), i.alias("id"), r.alias("row")))


#: A number in a text: fixed value, which results must agree with. It has a sign, a fraction, an exponent or a percent sign, and no letter or digit beside it.
NUMBER = r"(?<![A-Za-z0-9])[-+]?(?:[0-9]+(?:\.[0-9]+)?|\.[0-9]+)(?:[eE][-+]?[0-9]+)?%?(?![A-Za-z0-9])"


def _facts(text: str | None) -> Iterator[tuple[str, str, int | None, str, float]]:
    """(pointer, kind, token, exact, value) of each number, or number within a string, of a JSON text, in the order of the document with names of objects sorted."""
    try:
        work = [("", json.loads(text))] if text else []
    except ValueError:
        return
    while work:
        path, v = work.pop()
        if isinstance(v, dict):
            work += [(f"{path}/{k.replace('~', '~0').replace('/', '~1')}", v[k]) for k in sorted(v, reverse=True)]
        elif isinstance(v, list):
            work += [(f"{path}/{i}", x) for i, x in reversed(list(enumerate(v)))]
        elif isinstance(v, str):
            for i, m in enumerate(re.finditer(NUMBER, v), 1):
                yield path, "string_token", i, m[0], float(m[0].rstrip("%"))
        elif isinstance(v, (int, float)) and not isinstance(v, bool):
            yield path, "number", None, json.dumps(v), float(v)


def number_facts(df: DataFrame, id_col: str, json_col: str) -> DataFrame:
    """(id, fact_id, pointer, kind, token, exact, value): all numbers of the JSON texts, numbered Q0001 on over all rows in the order of
    their ids, and in a row by their place: lists by index, objects by name, a string's numbers from left to right (`token`).

    exact is the number as it is written; value leaves a percent sign out. Texts that aren't JSON have no facts. The texts are sorted by range,
    not their facts, which are numbered as they are found in a partition, behind those of the partitions before it."""
    from ..operators.relational import before_parts
    from ..sources.ranges import _batches
    from ..sources.tables import checkpointed

    rows = df.select(F.col(id_col).alias("id"), F.col(json_col).alias("j")).repartitionByRange("id").sortWithinPartitions("id")
    kinds = [("pointer", pa.string()), ("kind", pa.string()), ("token", pa.int32()), ("exact", pa.string()), ("value", pa.float64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            schema = pa.schema([batch.schema.field("id"), ("_part", pa.int32()), ("_at", pa.int64()), *kinds])
            facts = ((k, *f) for k, t in zip(batch.column("id").to_pylist(), batch.column("j").to_pylist()) for f in _facts(t))
            for found in _batches(((k, part, n, *f) for n, (k, *f) in enumerate(facts, at)), schema):
                at += len(found)
                yield found

    kind = rows.schema["id"].dataType.simpleString()
    found = checkpointed(rows.mapInArrow(run, f"id {kind}, _part int, _at long, pointer string, kind string, token int, exact string, value double"))
    placed = found.join(F.broadcast(before_parts(found, F.lit(1))), "_part").withColumn("ordinal", F.col("_before") + F.col("_at") + 1)
    return placed.select("id", F.format_string("Q%04d", "ordinal").alias("fact_id"), "pointer", "kind", "token", "exact", "value")


def _shrunk(v, items: int, depth: int, width: int):
    if isinstance(v, str):
        return v if len(v) <= width else v[:width] + "..."
    if isinstance(v, (dict, list)) and depth == 0:
        return "..."
    if isinstance(v, dict):
        return {k: _shrunk(x, items, depth - 1, width) for k, x in list(v.items())[:items]}
    if isinstance(v, list):
        return [_shrunk(x, items, depth - 1, width) for x in v[:items]]
    return v


def compacted(x: ColumnLike, items: int = 10, depth: int = 4, width: int = 240) -> Column:
    """A JSON text cut to so many items a level, levels, and signs a string, for reading. Recursion has no built-in form."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        def one(t):
            try:
                return None if t is None else json.dumps(_shrunk(json.loads(t), items, depth, width), sort_keys=True)
            except ValueError:
                return None

        return pd.Series([one(t) for t in s], dtype=object)

    return run(_c(x))


def without_keys(x: ColumnLike, forbidden: tuple[str, ...]) -> Column:
    """A JSON text without the named keys, at any depth."""
    gone = frozenset(k.lower() for k in forbidden)

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        def clean(v):
            if isinstance(v, dict):
                return {k: clean(y) for k, y in v.items() if k.lower() not in gone}
            return [clean(y) for y in v] if isinstance(v, list) else v

        def one(t):
            try:
                return None if t is None else json.dumps(clean(json.loads(t)), sort_keys=True)
            except ValueError:
                return None

        return pd.Series([one(t) for t in s], dtype=object)

    return run(_c(x))


def scan_form(x: ColumnLike) -> Column:
    """A text as forbidden words are looked for in it: references and percent escapes decoded, compatibility forms and format signs gone."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        import html
        import unicodedata
        from urllib.parse import unquote

        def one(t):
            if t is None:
                return None
            v = unicodedata.normalize("NFKC", html.unescape(t))
            for _ in range(2):
                v = unquote(v)
            return "".join(c for c in v if unicodedata.category(c) != "Cf")

        return pd.Series([one(t) for t in s], dtype=object)

    return run(_c(x))
