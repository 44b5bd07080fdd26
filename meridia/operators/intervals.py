"""Genomic intervals: bins, range joins and depth. BED is 0-based and half open, VCF positions are 1-based."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def genome_bins(contigs: DataFrame, width: int, contig: str = "contig", length: str = "length") -> DataFrame:
    """(contig, bin, start, end): fixed bins that cover each contig; the last may be shorter."""
    starts = F.when(F.col(length) > 0, F.sequence(F.lit(0).cast("long"), F.col(length).cast("long") - 1, F.lit(width).cast("long"))).otherwise(F.array().cast("array<bigint>"))
    out = contigs.select(F.col(contig).alias("contig"), F.col(length).cast("long").alias("_len"), F.posexplode(starts).alias("bin", "start"))
    return out.select("contig", F.col("bin").cast("long").alias("bin"), "start", F.least(F.col("start") + width, F.col("_len")).alias("end"))


#: Bins of one level that make one of the next, and the number of levels: widths up to `width` times 8^11.
FAN, LEVELS = 8, 12


def _nodes(low: Column, high: Column, width: int) -> Column:
    """Array of struct(level, bin): the fewest bins of all levels that make up the lowest bins from that of low to that of high, 14 a level at most."""
    first, last = F.floor(low / width), F.floor(high / width) + 1  # bins of level 0, the last exclusive

    def whole(k: int) -> tuple[Column, Column]:
        return F.ceil(first / FAN**k), F.floor(last / FAN**k)

    def run(k: int, a: Column, b: Column) -> Column:
        made = F.transform(F.sequence(a.cast("long"), b.cast("long") - 1), lambda x: F.struct(F.lit(k).alias("level"), x.alias("bin")))
        return F.when(a < b, made).otherwise(F.array().cast("array<struct<level:int,bin:bigint>>"))

    out = []
    for k in range(LEVELS - 1):
        a, b = whole(k)
        up, down = (x * FAN for x in whole(k + 1))
        out += [run(k, a, F.when(up < down, up).otherwise(b)), run(k, F.when(up < down, down).otherwise(b), b)]
    return F.concat(*out, run(LEVELS - 1, *whole(LEVELS - 1)))


def _in_ranges(points: DataFrame, at: Column, ranges: DataFrame, key: str, start: str, end: str, width: int) -> DataFrame:
    """Points p with ranges r, both with all their columns, where a bin of r holds p; `_at` is the point."""
    r = ranges.filter(F.col(end) > F.col(start)).withColumn("_node", F.explode(_nodes(F.col(start), F.col(end) - 1, width)))
    r = r.withColumn("_level", F.col("_node.level")).withColumn("_bin", F.col("_node.bin")).drop("_node")
    # Points look only at levels that ranges use: a dozen numbers at most.
    levels = sorted(x[0] for x in r.select("_level").distinct().collect())
    p = points.withColumn("_at", at).withColumn("_level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>")))
    p = p.withColumn("_bin", F.floor(F.col("_at") / F.element_at(F.array(*[F.lit(width * FAN**k) for k in range(LEVELS)]), F.col("_level") + 1)))
    return p.alias("p").join(r.alias("r"), [F.col(f"p.{c}") == F.col(f"r.{c}") for c in (key, "_level", "_bin")])


def points_in_ranges(points: DataFrame, ranges: DataFrame, key: str, pos: str, start: str, end: str, width: int, one_based: bool = False) -> DataFrame:
    """Points with each range of their key that holds them: start <= pos < end, 1-based points shifted down.

    An equi join on (key, level, bin): a range is made up of bins of `width`, of 8 times that, 64 times and so on, 14 of a level at most, so
    its length doesn't matter; a point has one bin on each level that ranges use. Each match is found once.
    """
    found = _in_ranges(points, F.col(pos) - int(one_based), ranges, key, start, end, width)
    found = found.filter((F.col("_at") >= F.col(f"r.{start}")) & (F.col("_at") < F.col(f"r.{end}")))
    return found.select(*[f"p.{c}" for c in points.columns], *[f"r.{c}" for c in ranges.columns if c != key])


def range_totals(points: DataFrame, ranges: DataFrame, key: str, pos: str, start: str, end: str, value: str, width: int) -> DataFrame:
    """Ranges, without their key, with parts of the number `n` of points in them and of the `total` of their values: a range's result is the sum
    of its parts, and one without points has none.

    No point meets a range that holds its whole bin: points are summed by bin, of `width` and of the larger sizes of points_in_ranges(), and
    a range takes the sums of the bins that make it up. Only the ends of a range, in a bin or two, meet places, summed too."""
    rest = [c for c in ranges.columns if c != key]
    sums = [F.sum("n").alias("n"), F.sum("total").alias("total")]
    places = points.groupBy(F.col(key).alias("_k"), F.col(pos).alias("_at")).agg(F.count("*").alias("n"), F.sum(value).alias("total"))
    places = places.withColumn("_bin", F.floor(F.col("_at") / width))
    r = ranges.filter(F.col(end) > F.col(start))
    first, last = F.ceil(F.col(start) / width), F.floor(F.col(end) / width)  # whole bins of level 0, the last exclusive
    whole = r.filter(first < last).withColumn("_node", F.explode(_nodes(first * width, last * width - 1, width))).select("*", "_node.*").drop("_node")
    # Sums are made on levels that ranges use: a dozen numbers at most.
    levels = sorted(x[0] for x in whole.select("level").distinct().collect())
    bins = places.groupBy("_k", "_bin").agg(*sums).withColumn("level", F.explode(F.array(*[F.lit(k) for k in levels]).cast("array<int>")))
    fan = F.element_at(F.array(*[F.lit(FAN**k) for k in range(LEVELS)]), F.col("level") + 1)
    bins = bins.groupBy("_k", "level", F.floor(F.col("_bin") / fan).alias("bin")).agg(*sums)
    inner = whole.join(bins, [F.col(key) == F.col("_k"), whole["level"] == bins["level"], whole["bin"] == bins["bin"]]).select(*rest, "n", "total")
    piece = lambda a, b: F.struct(a.cast("long").alias("_a"), b.cast("long").alias("_b"))
    ends = F.when(first < last, F.array(piece(F.col(start), first * width), piece(last * width, F.col(end)))).otherwise(F.array(piece(F.col(start), F.col(end))))
    edges = r.withColumn("_p", F.explode(ends)).select(*r.columns, "_p.*").filter("_a < _b")
    edges = edges.withColumn("_bin", F.explode(F.sequence(F.floor(F.col("_a") / width), F.floor((F.col("_b") - 1) / width))))
    outer = edges.join(places, [F.col(key) == F.col("_k"), edges["_bin"] == places["_bin"], F.col("_at") >= F.col("_a"), F.col("_at") < F.col("_b")])
    return inner.unionByName(outer.groupBy(*rest).agg(*sums))


def overlapping(a: DataFrame, b: DataFrame, key: str, width: int, a_cols: tuple[str, str] = ("a_start", "a_end"), b_cols: tuple[str, str] = ("b_start", "b_end")) -> DataFrame:
    """Pairs of ranges of a key that overlap (half open), of any length: one of them begins within the other. Each pair comes once. Empty ranges overlap nothing."""
    a, b = a.filter(F.col(a_cols[0]) < F.col(a_cols[1])), b.filter(F.col(b_cols[0]) < F.col(b_cols[1]))
    out = [*a.columns, *(c for c in b.columns if c != key)]
    mine = points_in_ranges(a, b, key, a_cols[0], *b_cols, width).select(*out)
    other = points_in_ranges(b, a, key, b_cols[0], *a_cols, width).filter(F.col(b_cols[0]) > F.col(a_cols[0])).select(*out)
    return mine.unionByName(other)


def reference_span(cigar: Column) -> Column:
    """Bases of the reference that an alignment covers: those of M, D, N, = and X; 0 where there is no CIGAR."""
    steps = F.regexp_extract_all(cigar, F.lit(r"(\d+)[MDN=X]"), F.lit(1))
    return F.coalesce(F.aggregate(steps, F.lit(0).cast("long"), lambda n, x: n + x.cast("long")), F.lit(0).cast("long"))


def reads_over_loci(reads: DataFrame, loci: DataFrame, width: int = 1024) -> DataFrame:
    """Mapped reads (rname, pos 1-based, cigar, flag, ...) with each locus (contig, start, end) that their alignment touches, gaps of a
    spliced one included; a read that covers no reference base takes up one."""
    mapped = reads.filter((F.col("flag").bitwiseAND(4) == 0) & (F.col("rname") != "*") & (F.col("pos") > 0))
    start = F.col("pos") - 1
    placed = mapped.withColumnRenamed("rname", "contig").withColumn("read_start", start).withColumn("read_end", start + F.greatest(reference_span(F.col("cigar")), F.lit(1)))
    return overlapping(placed, loci, "contig", width, ("read_start", "read_end"), ("start", "end"))


def depth_in_bins(depth: DataFrame, width: int, contig: str = "contig", pos: str = "pos", value: str = "depth") -> DataFrame:
    """(contig, bin, total): depth summed over fixed bins; the bin is a key, so no join is needed."""
    return depth.groupBy(F.col(contig).alias("contig"), F.floor((F.col(pos) - 1) / width).alias("bin")).agg(F.sum(value).alias("total"))


def contig_order(x: Column) -> Column:
    """1 to 22, X 23, Y 24, others 999."""
    bare = F.regexp_replace(x, "^chr", "")
    return F.coalesce(F.when(bare.rlike("^([1-9]|1[0-9]|2[0-2])$"), bare.try_cast("int")), F.when(bare == "X", 23), F.when(bare == "Y", 24), F.lit(999))


def standard_contig(x: Column) -> Column:
    """chr1 to chr22, chrX or chrY."""
    return x.rlike(r"^chr([1-9]|1[0-9]|2[0-2]|X|Y)$")


def missing_autosomes(contigs: DataFrame, contig: str, last: int) -> DataFrame:
    """(contig): autosomes from 1 to last that aren't there."""
    spark = contigs.sparkSession
    wanted = spark.range(1, last + 1).select(F.concat(F.lit("chr"), F.col("id").cast("string")).alias("contig"))
    return wanted.join(contigs.select(F.col(contig).alias("contig")).distinct(), "contig", "left_anti")
