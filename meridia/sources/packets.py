"""Packets: folders of Parquet parts that exist once their manifest does.

Each task writes its part under a name of its own, first with a temporary one, and tells the driver its rows, bytes and SHA-256, which
are taken as the bytes go out. The manifest, which lists the parts, is written last and in one move; so a packet is there as a whole
or not at all, and a part of a failed or repeated task is in no manifest. Readers take the parts that the manifest lists, after a check
of their bytes, and nothing else in the folder.

    spark.dataSource.register(PacketSink)
    df.write.format("meridia_packet").mode("append").option("about", '{"run": 7}').save(path)

Mode append makes a new packet and fails where there is one; overwrite replaces it, and removes the old parts once the new manifest stands.
Paths are addresses that pyarrow opens, on folders that driver and executors share.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import asdict, dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

MANIFEST = "manifest.json"
PIECE = 4 << 20


def _open(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path if "://" in path else f"file://{path.removeprefix('file:')}")


class _Hashed:
    """A file that is written, with the digest and number of its bytes."""

    def __init__(self, out: pa.NativeFile):
        self.out, self.sha256, self.size, self.closed = out, hashlib.sha256(), 0, False

    def write(self, data: bytes) -> int:
        self.out.write(data)
        self.sha256.update(data)
        self.size += len(data)
        return len(data)

    def flush(self) -> None:
        self.out.flush()

    def close(self) -> None:
        self.closed = True
        self.out.close()


@dataclass
class Part(WriterCommitMessage):
    """What a manifest says of a part."""

    name: str
    rows: int
    bytes: int
    sha256: str


def _put(files: fs.FileSystem, base: str, name: str, data: bytes) -> None:
    """A file with this content, in one move."""
    temporary = f"{base}/.{name}-{uuid.uuid4().hex}"
    with files.open_output_stream(temporary) as out:
        out.write(data)
    files.move(temporary, f"{base}/{name}")


def manifest(path: str) -> dict:
    """The manifest of a packet; fails where there is none."""
    files, base = _open(path)
    if files.get_file_info(f"{base}/{MANIFEST}").type != fs.FileType.File:
        raise FileNotFoundError(f"{path} has no manifest: it isn't installed")
    with files.open_input_stream(f"{base}/{MANIFEST}") as f:
        return json.loads(f.read())


def _write_manifest(path: str, parts: list[dict], schema: str, about: dict) -> None:
    files, base = _open(path)
    parts = sorted(parts, key=lambda p: p["name"])
    whole = hashlib.sha256("".join(f"{p['sha256']}  {p['name']}\n" for p in parts).encode()).hexdigest()
    content = {"about": about, "schema": json.loads(schema), "rows": sum(p["rows"] for p in parts), "bytes": sum(p["bytes"] for p in parts), "sha256": whole, "parts": parts}
    _put(files, base, MANIFEST, json.dumps(content, indent=1, sort_keys=True).encode())


class _Writer(DataSourceArrowWriter):
    def __init__(self, options: dict[str, str], schema: StructType, overwrite: bool):
        self.path, self.about, self.schema, self.job = options["path"], json.loads(options.get("about", "{}")), schema.json(), uuid.uuid4().hex
        try:
            self.old = [p["name"] for p in manifest(self.path)["parts"]]
        except FileNotFoundError:
            self.old = []
        else:
            if not overwrite:
                raise FileExistsError(f"{self.path} is installed already")
        files, base = _open(self.path)
        files.create_dir(base, recursive=True)

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        files, base = _open(self.path)
        name = f"part-{self.job}-{uuid.uuid4().hex}.parquet"
        rows, out, sink = 0, None, None
        try:
            for batch in iterator:
                if out is None:
                    sink = _Hashed(files.open_output_stream(f"{base}/.{name}"))
                    out = pq.ParquetWriter(pa.PythonFile(sink, mode="w"), batch.schema)
                out.write_batch(batch)
                rows += batch.num_rows
            if out is None:
                return Part("", 0, 0, "")
            out.close()
            sink.close()
        except BaseException:
            if sink is not None:
                sink.close()
                files.delete_file(f"{base}/.{name}")
            raise
        files.move(f"{base}/.{name}", f"{base}/{name}")
        return Part(name, rows, sink.size, sink.sha256.hexdigest())

    def commit(self, messages: list[Part | None]) -> None:
        parts = [asdict(m) for m in messages if m and m.name]
        _write_manifest(self.path, parts, self.schema, self.about)
        self._remove({p["name"] for p in parts}, self.old)

    def abort(self, messages: list[Part | None]) -> None:
        """Removes what the job's tasks have written so far; what one still running writes later stays unlisted, see clear_unlisted()."""
        self._remove(set(), [])

    def _remove(self, keep: set[str], more: list[str]) -> None:
        files, base = _open(self.path)
        own = [x.base_name for x in files.get_file_info(fs.FileSelector(base)) if x.base_name.lstrip(".").startswith(f"part-{self.job}-") and x.base_name not in keep]
        for name in [*own, *more]:
            files.delete_file(f"{base}/{name}")


class PacketSink(DataSource):
    """df.write.format("meridia_packet").mode("append" or "overwrite").save(path)"""

    @classmethod
    def name(cls) -> str:
        return "meridia_packet"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return _Writer(dict(self.options), schema, overwrite)


def _parts(spark: SparkSession, path: str, found: dict) -> DataFrame:
    """The parts of a manifest, a partition each; bounded by the number of tasks that wrote them."""
    rows = [(path, p["name"], p["rows"], p["bytes"], p["sha256"]) for p in found["parts"]]
    return spark.createDataFrame(rows, "path string, name string, rows long, bytes long, sha256 string").repartition(max(1, len(rows)))


def _digest(path: str, name: str) -> tuple[int | None, str | None]:
    """The bytes and SHA-256 of a file as it lies there; nulls where there is none."""
    files, base = _open(path)
    if files.get_file_info(f"{base}/{name}").type != fs.FileType.File:
        return None, None
    sha256, size = hashlib.sha256(), 0
    with files.open_input_stream(f"{base}/{name}") as f:
        while data := f.read(PIECE):
            sha256.update(data)
            size += len(data)
    return size, sha256.hexdigest()


def _copied(path: str, name: str, to: str) -> tuple[int | None, str | None]:
    """Copies a file in one move; the digest of the copy."""
    files, source = _open(path)
    there, base = _open(to)
    temporary = f".{name}-{uuid.uuid4().hex}"
    with files.open_input_stream(f"{source}/{name}") as f, there.open_output_stream(f"{base}/{temporary}") as out:
        while data := f.read(PIECE):
            out.write(data)
    there.move(f"{base}/{temporary}", f"{base}/{name}")
    return _digest(to, name)


def checked(spark: SparkSession, path: str, copy_to: str | None = None) -> DataFrame:
    """(name, rows, state) for each part of a packet: ok, missing, or altered, by its bytes and SHA-256 as read now. With copy_to parts are
    copied there, and it is the copy that is checked."""
    found = manifest(path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for r in batch.to_pylist():
                said = r["bytes"], r["sha256"]
                got = _digest(r["path"], r["name"])
                if copy_to and got == said:
                    got = _copied(r["path"], r["name"], copy_to)
                state = "missing" if got[0] is None else "ok" if got == said else "altered"
                out.append({"name": r["name"], "rows": r["rows"], "state": state})
            yield pa.RecordBatch.from_pylist(out, pa.schema([("name", pa.string()), ("rows", pa.int64()), ("state", pa.string())]))

    return _parts(spark, path, found).mapInArrow(run, "name string, rows long, state string")


def _all_ok(states: DataFrame, path: str) -> None:
    bad = states.filter("state <> 'ok'").orderBy("name").limit(5).collect()
    if bad:
        raise ValueError(f"{path}: " + ", ".join(f"{r['name']} is {r['state']}" for r in bad))


def installed(spark: SparkSession, path: str, check: bool = True) -> DataFrame:
    """The rows of a packet: of the parts that its manifest lists, each of which is checked first. Fails if a part isn't as listed."""
    found = manifest(path)
    if check:
        _all_ok(checked(spark, path), path)
    schema = StructType.fromJson(found["schema"])
    return spark.read.schema(schema).parquet(*[f"{path}/{p['name']}" for p in found["parts"]]) if found["parts"] else spark.createDataFrame([], schema)


def install(spark: SparkSession, staged: str, final: str) -> dict:
    """Copies a staged packet to its final folder: parts are checked before and after their copy, by the tasks that copy them, and the
    manifest comes last. Fails, and installs nothing, if a part isn't as listed; done again it starts over."""
    found = manifest(staged)
    files, base = _open(final)
    if files.get_file_info(f"{base}/{MANIFEST}").type == fs.FileType.File:
        raise FileExistsError(f"{final} is installed already")
    files.create_dir(base, recursive=True)
    _all_ok(checked(spark, staged, final), staged)
    _write_manifest(final, found["parts"], json.dumps(found["schema"]), found["about"])
    return manifest(final)


def _unlisted(path: str) -> list[str]:
    files, base = _open(path)
    try:
        listed = {p["name"] for p in manifest(path)["parts"]} | {MANIFEST}
    except FileNotFoundError:
        listed = set()
    return sorted(x.base_name for x in files.get_file_info(fs.FileSelector(base)) if x.is_file and x.base_name not in listed)


def unlisted(spark: SparkSession, path: str) -> DataFrame:
    """(name): files in a packet's folder that its manifest doesn't list."""
    return spark.createDataFrame([(n,) for n in _unlisted(path)], "name string")


def clear_unlisted(path: str) -> int:
    """Removes what failed writes have left in a packet's folder, while nothing is written there; says how many files."""
    files, base = _open(path)
    names = _unlisted(path)
    for name in names:
        files.delete_file(f"{base}/{name}")
    return len(names)
