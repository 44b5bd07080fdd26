"""Packets: whole or not there, checked parts, failures in between."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from meridia.sources import packets


@pytest.fixture(autouse=True)
def sink(spark):
    spark.dataSource.register(packets.PacketSink)


def save(df, path, mode="append", **options):
    df.write.format("meridia_packet").mode(mode).options(**options).save(str(path))


def frame(spark, n=100, parts=4):
    return spark.range(n).select("id", F.col("id").cast("string").alias("s"), F.array(F.col("id") * 2).alias("a")).repartition(parts, "id")


def test_a_packet_is_read_by_its_manifest(spark, tmp_path):
    df = frame(spark)
    save(df, tmp_path / "p", about='{"run": 7}')
    found = packets.manifest(str(tmp_path / "p"))
    assert found["rows"] == 100 and found["about"] == {"run": 7} and found["bytes"] == sum((tmp_path / "p" / x["name"]).stat().st_size for x in found["parts"])
    assert sorted(map(tuple, packets.installed(spark, str(tmp_path / "p")).collect())) == sorted(map(tuple, df.collect()))
    (tmp_path / "p" / "part-of-another-try.parquet").write_bytes(b"junk")
    assert packets.installed(spark, str(tmp_path / "p")).count() == 100
    assert [r["name"] for r in packets.unlisted(spark, str(tmp_path / "p")).collect()] == ["part-of-another-try.parquet"]
    with pytest.raises(Exception, match="installed already"):
        save(df, tmp_path / "p")


def test_an_altered_or_missing_part_is_refused(spark, tmp_path):
    save(frame(spark), tmp_path / "p")
    names = [x["name"] for x in packets.manifest(str(tmp_path / "p"))["parts"]]
    data = (tmp_path / "p" / names[0]).read_bytes()
    (tmp_path / "p" / names[0]).write_bytes(data[:-1] + bytes([data[-1] ^ 1]))
    (tmp_path / "p" / names[1]).unlink()
    states = {r["name"]: r["state"] for r in packets.checked(spark, str(tmp_path / "p")).collect()}
    assert states == {names[0]: "altered", names[1]: "missing"} | {n: "ok" for n in names[2:]}
    with pytest.raises(ValueError, match="altered.*missing|missing.*altered"):
        packets.installed(spark, str(tmp_path / "p"))
    with pytest.raises(ValueError):
        packets.install(spark, str(tmp_path / "p"), str(tmp_path / "final"))
    with pytest.raises(FileNotFoundError):
        packets.installed(spark, str(tmp_path / "final"))
    (tmp_path / "p" / names[0]).write_bytes(data)


def test_a_failed_write_leaves_nothing_installed(spark, tmp_path):
    bad = frame(spark).withColumn("s", F.when(F.col("id") == 57, F.raise_error(F.lit("broken row"))).otherwise(F.col("s")))
    with pytest.raises(Exception, match="broken row"):
        save(bad, tmp_path / "p")
    with pytest.raises(FileNotFoundError, match="no manifest"):
        packets.installed(spark, str(tmp_path / "p"))
    save(frame(spark), tmp_path / "p")
    assert packets.installed(spark, str(tmp_path / "p")).count() == 100
    left = packets.unlisted(spark, str(tmp_path / "p")).count()  # of tasks that ended after the job was given up
    assert packets.clear_unlisted(str(tmp_path / "p")) == left and packets.unlisted(spark, str(tmp_path / "p")).count() == 0
    assert packets.installed(spark, str(tmp_path / "p")).count() == 100


def test_overwriting_replaces_all_parts(spark, tmp_path):
    save(frame(spark), tmp_path / "p")
    old = {x["name"] for x in packets.manifest(str(tmp_path / "p"))["parts"]}
    save(frame(spark, 10, 2), tmp_path / "p", "overwrite")
    assert packets.installed(spark, str(tmp_path / "p")).count() == 10
    assert not old & {x.name for x in (tmp_path / "p").iterdir()}


def test_installing_goes_by_the_manifest(spark, tmp_path):
    save(frame(spark), tmp_path / "staged")
    (tmp_path / "staged" / "extra.parquet").write_bytes(b"junk")
    made = packets.install(spark, str(tmp_path / "staged"), str(tmp_path / "final"))
    assert made == packets.manifest(str(tmp_path / "staged"))
    assert packets.installed(spark, str(tmp_path / "final")).count() == 100
    assert {x.name for x in (tmp_path / "final").iterdir() if not x.name.endswith(".crc")} == {"manifest.json", *(p["name"] for p in made["parts"])}
    with pytest.raises(FileExistsError):
        packets.install(spark, str(tmp_path / "staged"), str(tmp_path / "final"))


def test_empty_packets(spark, tmp_path):
    save(frame(spark).limit(0), tmp_path / "p")
    got = packets.installed(spark, str(tmp_path / "p"))
    assert got.count() == 0 and got.columns == ["id", "s", "a"]
    assert json.loads((tmp_path / "p" / "manifest.json").read_text())["parts"] == []
