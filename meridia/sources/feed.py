"""A stream of paged logs, read by forward tokens: the offset holds a token for each stream, so a stopped query goes on where it was.

A page is asked for by its stream and token, "" being the beginning, and names the next token; one that names its own token says that
nothing follows yet. A slice takes at most `max_pages` pages of each stream, and begins none after `seconds`; pages are read by the
executors, a partition a stream. The driver asks for next tokens alone (`peek`), so that it knows where a slice ends before Spark logs it.
A batch whose end is logged is read again, after a failure, between the same tokens: a page with a next token doesn't change. Two queries
can't advance the same checkpoint; the one that comes second to an offset fails.

    spark.dataSource.register(TokenLogs)
    spark.readStream.format("meridia_logs").options(url=..., streams='["a", "b"]', fetch="package.module:function").load()

`fetch` is a function (url, params) -> JSON text with `events` and `next`, given by its import path; params are stream, token, and peek.
"""

from __future__ import annotations

import json
import time
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.types import StructType

from .rest import fetcher


class Slice(InputPartition):
    """Pages of a stream from one token up to another."""

    def __init__(self, stream: str, start: str, end: str):
        super().__init__((stream, start, end))
        self.stream, self.start, self.end = stream, start, end


class TokenReader(DataSourceStreamReader):
    """See the module."""

    def __init__(self, options: dict[str, str]):
        self.options = dict(options)
        self.streams = [str(s) for s in json.loads(options["streams"])]
        self.pages, self.seconds = int(options.get("max_pages", "100")), float(options.get("seconds", "60"))
        if self.pages < 1 or self.seconds < 0:
            raise ValueError("max_pages must be positive and seconds not negative")
        self.at: dict[str, str] | None = None

    def initialOffset(self) -> dict:  # noqa: N802
        return {s: "" for s in self.streams}

    def _page(self, stream: str, token: str, peek: bool = False) -> dict:
        return json.loads(fetcher(self.options)(self.options["url"], {"stream": stream, "token": token} | ({"peek": "1"} if peek else {})))

    def _ahead(self, stream: str, token: str, until: float) -> str:
        for n in range(self.pages):
            if n and time.monotonic() >= until:
                break
            following = self._page(stream, token, peek=True)["next"]
            if following == token:
                break
            token = following
        return token

    def latestOffset(self) -> dict:  # noqa: N802
        now = self.initialOffset() | (self.at or {})
        until = time.monotonic() + self.seconds
        with ThreadPoolExecutor(16) as pool:
            ends = pool.map(lambda s: self._ahead(s, now[s], until), self.streams)
            self.at = now | dict(zip(self.streams, ends))
        return self.at

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        # After a restart Spark plans the last logged batch first; its end is where this reader goes on.
        self.at = self.at or dict(end)
        return [Slice(s, start.get(s, ""), end[s]) for s in end if start.get(s, "") != end[s]]

    def read(self, partition: Slice) -> Iterator[tuple]:
        token = partition.start
        while token != partition.end:
            page = self._page(partition.stream, token)
            if page["next"] == token:
                raise RuntimeError(f"{partition.stream!r} ends at {token!r}, before {partition.end!r}, which it named before")
            for n, event in enumerate(page["events"]):
                yield partition.stream, token, n, json.dumps(event)
            token = page["next"]

    def commit(self, end: dict) -> None:
        """Nothing to free: pages stay with the service, the cursor with the checkpoint."""


class TokenLogs(DataSource):
    """spark.readStream.format("meridia_logs"): rows (stream, token, ordinal, record), the record as JSON."""

    @classmethod
    def name(cls) -> str:
        return "meridia_logs"

    def schema(self) -> str:
        return "stream string, token string, ordinal int, record string"

    def streamReader(self, schema: StructType) -> DataSourceStreamReader:  # noqa: N802
        return TokenReader(self.options)


def staged_log(url: str, params: dict[str, str]) -> str:
    """A log whose pages are staged as lines of JSON under `url`/stream=`stream`/page=`number`, as a partitioned write leaves them; blank lines hold no event."""
    from pyarrow import fs

    files, base = fs.FileSystem.from_uri(url)
    number = int(params["token"] or 0)
    found = files.get_file_info(fs.FileSelector(f"{base}/stream={params['stream']}/page={number}", allow_not_found=True))
    found = sorted(x.path for x in found if x.is_file and not x.base_name.startswith((".", "_")))
    if not found:
        return json.dumps({"events": [], "next": params["token"]})
    events = []
    for path in [] if "peek" in params else found:
        with files.open_input_stream(path) as f:
            events += [json.loads(line) for line in f.read().decode().split("\n") if line]
    return json.dumps({"events": events, "next": str(number + 1)})
