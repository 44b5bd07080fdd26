"""Cases of the findings of round 4, each of which failed before its change."""

from __future__ import annotations

import pytest

from meridia import plans
from meridia.sources import genomics as g
from meridia.sources import ranges


def _joins(df) -> tuple[list, str]:
    """Rows, and the plan that was run in the end."""
    return df.collect(), df._jdf.queryExecution().executedPlan().toString()


def test_reads_are_not_broadcast_by_the_size_of_their_splits(spark, tmp_path):
    for n, count in ((1, 3_000), (2, 2_000)):
        (tmp_path / f"{n}.txt").write_bytes(b"".join(b"@r%d\nAC\n+\n@+\n" % (i * n) for i in range(count)))
    one, two = (g.fastq(spark, str(tmp_path / f"{n}.txt"), split=512).select("ordinal", "id") for n in (1, 2))
    for how, rows in (("left", 3_000), ("inner", 1)):
        got, plan = _joins(one.join(two, ["ordinal", "id"], how))
        assert len(got) == rows and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


@pytest.mark.parametrize("read", [lambda f: ranges.text_lines(f, split=64).withColumnRenamed("value", "k"), lambda f: ranges.byte_ranges(f, 8).withColumnRenamed("content", "k")])
def test_lines_and_ranges_are_not_broadcast_by_the_size_of_their_splits(spark, tmp_path, read):
    (tmp_path / "f.txt").write_bytes(b"0123456\n" * 100)
    found = ranges.files(spark, str(tmp_path / "f.txt"))
    got, plan = _joins(read(found).select("k").distinct().join(read(found).select("k"), "k"))
    assert len(got) == 100 and "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_split_reads_join_their_mates_without_a_broadcast(spark):
    sf = "/root/testdata/sf0.001"
    got, plan = _joins(plans.queries()["s09_split_reads"](spark, sf))
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    keys: dict[int, list[int]] = {}
    for k, file in sorted((r.l_orderkey, r.l_linenumber) for r in spark.read.parquet(f"{sf}/lineitem.parquet").select("l_orderkey", "l_linenumber").collect()):
        keys.setdefault(file, []).append(k)
    second = dict(enumerate(keys[2]))
    assert sorted(map(tuple, got)) == sorted((file, i, f"r{k}", file == 1 and second.get(i) == k) for file, ks in keys.items() for i, k in enumerate(ks))
