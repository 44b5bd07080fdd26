"""A paged REST or GraphQL source as a Python data source: one partition a request key, pages fetched in the executors.

Pages go by number, by a continuation token in the answer (`token` names its field), or come from a job that is submitted and
polled (`mode` job). Options max_rows and max_pages bound a key: the first ends it, the second fails. Options params and fixes (JSON) add
parameters to each request and rename them by the end of its address, see normalised_params().

`fetch` is a function (url, params) -> JSON text given by its import path, so that tests and private networks bring their own.
"""

from __future__ import annotations

import importlib
import json
import time
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType


def urllib_fetch(url: str, params: dict[str, str]) -> str:
    """A GET, or a POST where params hold `body`."""
    import urllib.parse
    import urllib.request

    params = dict(params)
    body = params.pop("body", None)
    full = f"{url}?{urllib.parse.urlencode(params)}" if params else url
    with urllib.request.urlopen(urllib.request.Request(full, body.encode() if body else None, {"Content-Type": "application/json"}), timeout=60) as r:
        return r.read().decode()


def fetcher(options: dict[str, str], fetch: Callable | None = None) -> Callable:
    """The function given, or that option `fetch` names. What fails as a connection does, or as a server does for a while (429, 5xx), is tried
    `tries` times in all, after `wait_seconds`, doubled each time; other answers fail at once."""
    if fetch is None:
        module, _, name = options.get("fetch", "meridia.sources.rest:urllib_fetch").partition(":")
        fetch = getattr(importlib.import_module(module), name)
    tries, wait = int(options.get("tries", "3")), float(options.get("wait_seconds", "1"))

    def run(url: str, params: dict[str, str]):
        for attempt in range(tries):
            try:
                return fetch(url, params)
            except OSError as e:
                code = getattr(e, "code", None)
                if attempt == tries - 1 or code is not None and code != 429 and code < 500:
                    raise
                time.sleep(wait * 2**attempt)
        raise ValueError("tries must be positive")

    return run


def staged_fetch(url: str, params: dict[str, str]) -> str:
    """A page that was staged under `url`/q=`q`/page=`page` in a folder that all executors see, as a partitioned write leaves it;
    blank pages past the last. A body with variables gives q and page as a GraphQL request does, a token is a page's name, and so is an
    operation on a job with the number of its poll."""
    from pyarrow import fs

    if "body" in params:
        params = params | {k: str(v) for k, v in json.loads(params["body"])["variables"].items()}
    files, base = fs.FileSystem.from_uri(url)
    page = params.get("token") or (params["op"] + params.get("poll", "") if "op" in params else params["page"])
    found = files.get_file_info(fs.FileSelector(f"{base}/q={params['q']}/page={page}", allow_not_found=True))
    found = [x.path for x in found if x.is_file and not x.base_name.startswith((".", "_"))]
    if not found:
        return "[]"
    with files.open_input_stream(min(found)) as f:
        return f.read().decode()


@lru_cache(4)
def _staged_groups(url: str) -> list[tuple]:
    """(lowest id, highest id, row group) of Parquet files under an address, whose footers a process reads once; None where it isn't known."""
    import pyarrow.dataset as ds
    from pyarrow import fs

    files, base = fs.FileSystem.from_uri(url)
    groups = [g for f in ds.dataset(base, format="parquet", filesystem=files).get_fragments() for g in f.split_by_row_group()]
    known = [(g.row_groups[0].statistics or {}).get("id", {}) for g in groups]
    return [(s.get("min"), s.get("max"), g) for s, g in zip(known, groups)]


def staged_answers(url: str, params: dict[str, str]) -> str:
    """Answers that were staged as Parquet rows (id, record), once and for all: those of the ids that a posted body names, as {"items": [...]}.
    Only row groups that may hold one of them are read, few where the rows are sorted by id."""
    import pyarrow.dataset as ds

    wanted = [str(x) for x in json.loads(params["body"])["ids"]]
    low, high = min(wanted, default=""), max(wanted, default="")
    near = [g for a, b, g in _staged_groups(url) if a is None or b is None or a <= high and b >= low]
    found = [x for g in near for x in g.to_table(columns=["record"], filter=ds.field("id").isin(wanted))["record"].to_pylist()]
    return json.dumps({"items": [json.loads(x) for x in found]})


def normalised_params(params: dict[str, object], path: str, fixes: dict[str, dict[str, str]]) -> dict[str, str]:
    """Parameters as a service takes them: nulls go, truth values are lower-case words, lists are comma-joined; names that `fixes` has for a
    path that ends with one of its keys are renamed, where the right name isn't there already."""
    rename = next((names for tail, names in fixes.items() if path.rstrip("/").endswith(tail)), {})
    out: dict[str, str] = {}
    for name, value in params.items():
        if value is None:
            continue
        right = rename.get(name, name)
        if right != name and params.get(right) is not None:
            continue
        out[right] = str(value).lower() if isinstance(value, bool) else ",".join(map(str, value)) if isinstance(value, (list, tuple)) else str(value)
    return out


def posted(ids: DataFrame, column: str, url: str, size: int, options: dict[str, str], name: str = "ids", records: str = "items", more: dict[str, object] | None = None) -> DataFrame:
    """(ids, record): answers, as JSON, to requests of at most `size` ids each, posted as {name: [...], **more}. Ids are distinct, sorted over all
    tasks, and cut within each; a request that fails as a connection does is tried again by itself (see fetcher)."""
    rows = ids.select(F.col(column).cast("string").alias("id")).filter("id IS NOT NULL").distinct().repartitionByRange("id").sortWithinPartitions("id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fetch = fetcher(options)

        def ask(chunk: list[str]) -> pa.RecordBatch:
            found = json.loads(fetch(url, {"body": json.dumps({name: chunk, **(more or {})})}))
            for part in filter(None, records.split(".")):
                found = found.get(part) if isinstance(found, dict) else found
            if not isinstance(found, list):
                raise TypeError(f"{url}: no list of records in an answer")
            return pa.RecordBatch.from_pydict({"ids": pa.array([len(chunk)] * len(found), pa.int32()), "record": pa.array([json.dumps(x) for x in found], pa.string())})

        held: list[str] = []
        for batch in batches:
            held += batch.column(0).to_pylist()
            while len(held) >= size:
                yield ask(held[:size])
                held = held[size:]
        if held:
            yield ask(held)

    return rows.mapInArrow(run, "ids int, record string")


class _Key(InputPartition):
    def __init__(self, key: str):
        super().__init__(key)
        self.key = key


class _Reader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options = dict(options)

    def partitions(self) -> list[InputPartition]:
        return [_Key(k) for k in json.loads(self.options.get("keys", '[""]'))]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        fetch = fetcher(self.options)
        limit, rows_left = int(self.options.get("max_pages", "1000")), int(self.options.get("max_rows", "1000000000"))
        records = self.options.get("records", "")
        token, page = "", 0
        while True:
            if page == limit:
                raise RuntimeError(f"more than {limit} pages of {partition.key!r}; raise max_pages")
            params = {self.options.get("key_param", "q"): partition.key, self.options.get("page_param", "page"): str(page)}
            if "params" in self.options or "fixes" in self.options:
                params = normalised_params(json.loads(self.options.get("params", "{}")) | params, self.options["url"], json.loads(self.options.get("fixes", "{}")))
            if token:
                params["token"] = token
            if "body" in self.options:
                params["body"] = self.options["body"].replace("{key}", partition.key).replace("{page}", str(page))
            if self.options.get("mode") == "job":
                answer = json.loads(self._job(fetch, partition.key))
            else:
                answer = json.loads(fetch(self.options["url"], params))
            if isinstance(answer, dict) and answer.get("errors"):
                raise RuntimeError(f"{partition.key!r}: {answer['errors']}")
            found = answer
            for part in filter(None, records.split(".")):
                found = (found.get(part) or []) if isinstance(found, dict) else found
            found = found if isinstance(found, list) else [found] if found else []
            for x in found[:rows_left]:
                yield partition.key, page, json.dumps(x)
            rows_left -= len(found)
            token = answer.get(self.options["token"]) if "token" in self.options and isinstance(answer, dict) else None
            last = not token if "token" in self.options else not found
            page += 1
            if last or rows_left <= 0 or self.options.get("mode") == "job" or self.options.get("paged", "true") == "false":
                return

    def _job(self, fetch, key: str) -> str:
        """Submits, asks until the job is ready, and fetches its result."""
        url, wait = self.options["url"], float(self.options.get("poll_seconds", "5"))
        job = json.loads(fetch(url, {"op": "submit", "q": key}))["id"]
        for n in range(int(self.options.get("max_polls", "100"))):
            status = json.loads(fetch(url, {"op": "status", "q": job, "poll": str(n)}))["status"]
            if status == "READY":
                return fetch(url, {"op": "result", "q": job})
            if status != "WAITING":
                raise RuntimeError(f"job {job} ended as {status}")
            time.sleep(wait)
        raise RuntimeError(f"job {job} isn't ready")


class RestDataSource(DataSource):
    """spark.read.format("meridia_rest").options(url=..., keys='["a","b"]', records="data.items").load()"""

    @classmethod
    def name(cls) -> str:
        return "meridia_rest"

    def schema(self) -> str:
        return "key string, page int, record string"

    def reader(self, schema: StructType) -> DataSourceReader:
        return _Reader(self.options)
