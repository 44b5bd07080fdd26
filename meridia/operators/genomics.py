"""Counters and matrices over variants, alignments, reads and coverage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import log2_ratio
from ..functions.rules import coverage_class, discordant, plain_snv, supplementary
from ..functions.text import pyrimidine_context
from .aggregates import quantiles


def sbs96_contexts(spark: SparkSession) -> DataFrame:
    """(context): the 96 classes, as a product of six changes and two neighbours."""
    one = lambda name, values: F.explode(F.array(*[F.lit(v) for v in values])).alias(name)
    changes = spark.range(1, numPartitions=1).select(one("c", [f"{r}>{a}" for r in "CT" for a in "ACGT" if r != a]))
    return changes.select("c", one("l", "ACGT")).select("c", "l", one("n", "ACGT")).select(F.concat("l", F.lit("["), "c", F.lit("]"), "n").alias("context"))


def sbs96_matrix(variants: DataFrame, context: str = "context3", pass_fallback: bool = False, on_bad: str = "skip", check_ref: bool = False) -> DataFrame:
    """(context, n) for all 96 classes, of variants (ref, alt, filter, context3).

    Only PASS rows count; with pass_fallback all do when none passes. Alleles that fit no class are skipped, or fail the
    query with on_bad='fail'; check_ref fails it where the context's middle base isn't REF. Rows are counted by their raw context and
    alleles first, of which there are few, and only these are named.
    """
    raw = variants.groupBy(F.col(context).alias("_c"), "ref", "alt").agg(F.count("*").alias("_all"), F.count_if(F.col("filter") == "PASS").alias("_pass"))
    if pass_fallback:
        passing = raw.agg(F.coalesce(F.sum("_pass"), F.lit(0)).alias("_any"))
        rows = raw.crossJoin(F.broadcast(passing)).withColumn("n", F.when(F.col("_any") > 0, F.col("_pass")).otherwise(F.col("_all")))  # one row
    else:
        rows = raw.withColumn("n", F.col("_pass"))
    rows = rows.filter("n > 0").filter(plain_snv("ref", "alt"))
    if check_ref:
        wrong = F.upper(F.substring("_c", 2, 1)) != F.upper("ref")
        rows = rows.withColumn("ref", F.when(wrong, F.raise_error(F.lit("context base differs from REF")).cast("string")).otherwise(F.col("ref")))
    named = pyrimidine_context("_c", "ref", "alt")
    if on_bad == "fail":
        named = F.coalesce(named, F.raise_error(F.lit("variant fits no class")).cast("string"))
    counts = rows.groupBy(named.alias("context")).agg(F.sum("n").alias("n"))
    return sbs96_contexts(variants.sparkSession).join(counts, "context", "left").select("context", F.coalesce("n", F.lit(0)).alias("n"))


def matrix_differences(a: DataFrame, b: DataFrame) -> DataFrame:
    """Classes whose counts differ between two matrices."""
    from .relational import compare_sides

    return compare_sides(a, b, ["context"], "n").filter("state <> 'equal'")


def variant_counters(variants: DataFrame) -> DataFrame:
    """One row: distinct keys, PASS rows, SNV and indel keys; a record counts once for each ALT. Rows are grouped by their key once, and the
    groups counted, so that no row is copied for each of the counts."""
    key = F.concat_ws(":", "contig", F.col("pos").cast("string"), "ref", "alt")
    snv = plain_snv("ref", "alt")
    by = variants.groupBy(key.alias("_key")).agg(F.count_if(F.col("filter") == "PASS").alias("_pass"), F.bool_or(snv).alias("_snv"), F.bool_or(~snv).alias("_other"))
    return by.agg(F.count("*").alias("total"), F.coalesce(F.sum("_pass"), F.lit(0)).alias("passed"), F.count_if("_snv").alias("snv"), F.count_if("_other").alias("indel"))


def split_alleles(records: DataFrame, alt: str = "alt") -> DataFrame:
    """One row an ALT allele."""
    return records.withColumn(alt, F.explode(F.split(F.col(alt), ",")))


def alignment_counters(alignments: DataFrame, large: int = 100_000) -> DataFrame:
    """One row: supplementary, discordant, interchromosomal and large-insert reads, in one scan."""
    mate = F.col("rnext")
    return alignments.agg(
        F.count("*").alias("reads"),
        F.count_if(supplementary("flag")).alias("supplementary"),
        F.count_if(discordant("flag")).alias("discordant"),
        F.count_if(~mate.isin("=", "*") & (mate != F.col("rname"))).alias("interchromosomal"),
        F.count_if(mate.isin("=") & (F.abs("tlen") > large)).alias("large_insert"),
    )


def flag_counts(alignments: DataFrame) -> DataFrame:
    """One row of counts by flag bits: total, mapped, paired, properly paired, duplicates, secondary, supplementary."""
    bit = lambda b: F.col("flag").bitwiseAND(b) != 0
    primary = ~bit(256) & ~bit(2048)
    return alignments.agg(
        F.count("*").alias("total"),
        F.count_if(~bit(4)).alias("mapped"),
        F.count_if(bit(1) & primary).alias("paired"),
        F.count_if(bit(2) & bit(1) & ~bit(4) & primary).alias("proper"),
        F.count_if(bit(1024)).alias("duplicates"),
        F.count_if(bit(256)).alias("secondary"),
        F.count_if(bit(2048)).alias("supplementary"),
    )


def read_metrics(reads: DataFrame, keys: list[str]) -> DataFrame:
    """Reads, lengths, GC and N shares, quality range, first and last id, of reads (id, sequence, quality, ordinal)."""
    n = lambda signs: F.length(F.regexp_replace(F.upper("sequence"), f"[^{signs}]", ""))
    codes = F.transform(F.filter(F.split("quality", ""), lambda s: s != ""), F.ascii)
    total = F.sum(F.length("sequence"))
    return reads.groupBy(*keys).agg(
        F.count("*").alias("reads"),
        F.min(F.length("sequence")).cast("long").alias("min_length"),
        F.max(F.length("sequence")).cast("long").alias("max_length"),
        F.round(F.avg(F.length("sequence")), 2).alias("mean_length"),
        F.round(F.try_divide(F.sum(n("GC")), total), 4).alias("gc"),
        F.round(F.try_divide(F.sum(n("N")), total), 4).alias("n_share"),
        F.min(F.array_min(codes)).cast("long").alias("min_quality"),
        F.max(F.array_max(codes)).cast("long").alias("max_quality"),
        F.min_by("id", "ordinal").alias("first_id"),
        F.max_by("id", "ordinal").alias("last_id"),
    )


def expected_counts(metrics: DataFrame, expected: DataFrame, keys: list[str]) -> DataFrame:
    """metrics whose `reads` are as many as `expected` says; any other number, or a key that isn't expected, fails the query."""
    joined = metrics.join(expected.select(*keys, F.col("expected").alias("_e")), keys, "left")
    said = F.concat(F.lit("expected "), F.coalesce(F.col("_e").cast("string"), F.lit("none")), F.lit(" reads, found "), F.col("reads").cast("string"))
    return joined.withColumn("reads", F.when(F.col("reads").eqNullSafe(F.col("_e")), F.col("reads")).otherwise(F.raise_error(said).cast("long"))).drop("_e")


def coverage_bins(depths: DataFrame) -> DataFrame:
    """Bins (contig, start, end, tumor_sum, normal_sum) with mean depths, log2 ratio and class."""
    length = F.col("end") - F.col("start")
    t, n = F.col("tumor_sum") / length, F.col("normal_sum") / length
    ratio = log2_ratio(t, n)
    return depths.select("*", length.alias("length"), F.round(t, 6).alias("tumor_mean"), F.round(n, 6).alias("normal_mean"), F.round(ratio, 4).alias("log2_ratio"), coverage_class(ratio).alias("coverage_class"))


def coverage_summary(binned: DataFrame) -> DataFrame:
    """One row: bins, median ratio, gains and losses."""
    is_ = lambda c: F.count_if(F.col("coverage_class") == c)
    counts = binned.agg(F.count("*").alias("bins"), is_("relative_gain").alias("gains"), is_("relative_loss").alias("losses"))
    median = quantiles(binned, [], "log2_ratio", {"median_log2": 0.5})
    return counts.join(median, how="left").select("bins", F.round("median_log2", 4).alias("median_log2"), "gains", "losses")


def depth_summary(depths: DataFrame, tumor: str, normal: str, least: int = 10) -> DataFrame:
    """One row: positions, mean depths, those deep enough in both and their share."""
    both = (F.col(tumor) >= least) & (F.col(normal) >= least)
    return depths.agg(F.count("*").alias("positions"), F.round(F.avg(tumor), 4).alias("tumor_mean"), F.round(F.avg(normal), 4).alias("normal_mean"), F.count_if(both).alias("covered"), F.round(F.avg(both.cast("double")), 4).alias("covered_share"))


def reference_base(variants: DataFrame, chunks: DataFrame, width: int, flank: int = 1) -> DataFrame:
    """Variants (contig, pos 1-based) with the bases around them, from a reference in chunks (contig, chunk, seq with `flank` bases of the next chunks on both sides).

    An equi join on (contig, chunk): no random access.
    """
    v = variants.withColumn("chunk", F.floor((F.col("pos") - 1) / width))
    at = (F.col("pos") - 1 - F.col("chunk") * width).cast("int")
    return v.join(chunks, ["contig", "chunk"], "left").withColumn("bases", F.substr("seq", at + 1, F.lit(2 * flank + 1))).drop("chunk", "seq")


def reference_agrees(variants: DataFrame, chunks: DataFrame, width: int) -> DataFrame:
    """Variants (contig, pos 1-based, ref, ...) whose REF is the reference's, from chunks (contig, chunk, seq) of `width` bases: each distinct
    REF is cut at the chunks' ends and every piece compared, so its length doesn't matter."""
    refs = variants.select("contig", "pos", "ref").distinct()
    last = F.floor((F.col("pos") + F.length("ref") - 2) / width)
    pieces = refs.withColumn("chunk", F.explode(F.sequence(F.floor((F.col("pos") - 1) / width), last)))
    low = F.greatest(F.col("pos") - 1, F.col("chunk") * width)
    high = F.least(F.col("pos") - 1 + F.length("ref"), (F.col("chunk") + 1) * width)
    said = F.substr("ref", (low - F.col("pos") + 2).cast("int"), (high - low).cast("int"))
    found = F.substr("seq", (low - F.col("chunk") * width + 1).cast("int"), (high - low).cast("int"))
    good = pieces.join(chunks, ["contig", "chunk"], "left").groupBy("contig", "pos", "ref").agg(F.every(F.coalesce(F.upper(said) == F.upper(found), F.lit(False))).alias("_good"))
    return variants.join(good.filter("_good").drop("_good"), ["contig", "pos", "ref"], "left_semi")


def _common_tail(a: Column, b: Column, upto: int) -> Column:
    """How many last signs two texts share, fewer than `upto`: found by halving, as k last signs are the same only where fewer are. That takes
    a loop a row, which isn't compiled; the most frequent cases, in which the last sign says all, go without."""
    bits = F.array(*[F.lit(1 << i) for i in reversed(range(max(1, (upto - 1).bit_length())))])

    def longer(k: Column, bit: Column) -> Column:
        n = k + bit
        return F.when((n <= F.length(a)) & (n <= F.length(b)) & (F.right(a, n) == F.right(b, n)), n).otherwise(k)

    x, y = F.right(a, F.lit(1)), F.right(b, F.lit(1))
    return F.when(x != y, 0).when((x == y) & (x != "") & ((F.length(a) == 1) | (F.length(b) == 1)), 1).otherwise(F.aggregate(bits, F.lit(0), longer))


def left_aligned(variants: DataFrame, chunks: DataFrame, width: int, most_mismatches: int | None = None) -> DataFrame:
    """Variants (contig, pos 1-based, ref, alt, ...) as far left as they go, and trimmed, whatever the length of the run that they lie in.
    Those whose REF isn't the reference's are left out; more than `most_mismatches` of them fail the query.

    chunks are the reference (contig, chunk, seq) in pieces of `width` bases. A variant that becomes an insertion or a deletion of d bases
    moves by the length of the tail that the bases before it, followed by those d, share with the bases before it alone. That is taken
    within the chunk before it; variants that reach its start go on with the next chunk, in rounds, until none does. Each round is an
    equi join of the variants that still move. At a contig's start the base after the variant is its anchor.
    """
    from ..sources.tables import checkpointed

    rest = [c for c in variants.columns if c not in ("contig", "pos", "ref", "alt")]
    good = reference_agrees(variants, chunks, width)
    if most_mismatches is not None:
        bad = variants.join(good.select("contig", "pos", "ref").distinct(), ["contig", "pos", "ref"], "left_anti").count()
        if bad > most_mismatches:
            raise RuntimeError(f"{bad} variants don't fit the reference, {most_mismatches} at most may")
    r, a = F.upper("ref"), F.upper("alt")
    rows = good.select("contig", F.col("pos").cast("long").alias("pos"), r.alias("r"), a.alias("a"), F.struct(*rest).alias("rest") if rest else F.lit(0).alias("rest"))
    # Bases that both alleles share at their ends; where that is all of one, the other is a pure insertion or deletion.
    rows = rows.withColumn("tail", _common_tail(F.col("r"), F.col("a"), 1 << 16))
    cut = lambda x: F.substr(x, F.lit(1), F.length(x) - F.col("tail"))
    rows = rows.withColumn("r", cut(F.col("r"))).withColumn("a", cut(F.col("a"))).drop("tail")
    rows = checkpointed(rows)
    moving = ((F.col("r") == "") | (F.col("a") == "")) & (F.col("r") != F.col("a"))
    still = rows.filter(~moving)
    # (pos, x): x is what is put in or taken out before the base at pos.
    now = rows.filter(moving).select("contig", "pos", F.concat("r", "a").alias("x"), (F.col("r") == "").alias("more"), "rest")
    settled, pieces = None, chunks.select("contig", "chunk", F.upper("seq").alias("seq"))
    while True:
        at = now.withColumn("chunk", F.floor((F.col("pos") - 2) / width)).join(pieces, ["contig", "chunk"], "left")
        before = F.when(F.col("pos") > 1, F.substr("seq", F.lit(1), (F.col("pos") - 1 - F.col("chunk") * width).cast("int"))).otherwise("")
        at = at.withColumn("before", before)
        # A single base shares the run of itself that `before` ends with.
        run = F.coalesce(F.length("before") - F.length(F.rtrim(F.col("before"), F.col("x"))), F.lit(0))
        at = at.withColumn("k", F.when(F.length("x") == 1, run).otherwise(_common_tail(F.concat("before", "x"), F.col("before"), width + 1)))
        # What x has become after k steps: the d bases that end k before the end of `before` and x.
        turned = F.substr(F.concat("before", "x"), F.length("before") - F.col("k") + 1, F.length("x"))
        anchor = F.when(F.col("k") < F.length("before"), F.substr("before", F.length("before") - F.col("k"), F.lit(1)))
        at = checkpointed(at.select("contig", (F.col("pos") - F.col("k")).alias("pos"), turned.alias("x"), "more", "rest", anchor.alias("anchor")))
        done = at.filter("anchor IS NOT NULL OR pos = 1")
        settled = done if settled is None else settled.unionByName(done)
        now = at.filter("anchor IS NULL AND pos > 1").drop("anchor")
        if now.isEmpty():
            break
    # At the start of a contig: the base after the variant, which for a deletion is the one after what is taken out.
    after = F.when(F.col("more"), F.lit(0)).otherwise(F.length("x"))
    edge = settled.filter("anchor IS NULL").withColumn("chunk", F.floor(after / width)).join(pieces, ["contig", "chunk"], "left")
    edge = edge.withColumn("b", F.substr("seq", (after - F.col("chunk") * width + 1).cast("int"), F.lit(1)))
    whole = F.concat("x", "b")
    first = edge.select("contig", "pos", F.when(F.col("more"), F.col("b")).otherwise(whole).alias("ref"), F.when(F.col("more"), whole).otherwise(F.col("b")).alias("alt"), "rest")
    with_x = F.concat("anchor", "x")
    inner = settled.filter("anchor IS NOT NULL").select("contig", (F.col("pos") - 1).alias("pos"), F.when(F.col("more"), F.col("anchor")).otherwise(with_x).alias("ref"), F.when(F.col("more"), with_x).otherwise(F.col("anchor")).alias("alt"), "rest")
    # The rest loses the first bases that both alleles share, but for the last of one.
    head = F.least(_common_tail(F.reverse("r"), F.reverse("a"), 1 << 16), F.greatest(F.least(F.length("r"), F.length("a")) - 1, F.lit(0)))
    still = still.withColumn("h", head).select("contig", (F.col("pos") + F.col("h")).alias("pos"), F.substr("r", F.col("h") + 1, F.length("r")).alias("ref"), F.substr("a", F.col("h") + 1, F.length("a")).alias("alt"), "rest")
    out = still.unionByName(inner).unionByName(first)
    return out.select("contig", "pos", "ref", "alt", *([F.col("rest")[c].alias(c) for c in rest]))


def resolved_variants(asked: DataFrame, known: DataFrame) -> DataFrame:
    """What is asked (id, kind, value) in both builds: (id, rsid, grch37, grch38, state, warnings).

    known has a row an rs number and build: (rsid, build, chrom, pos, ref, alts). kind is rsid, or grch37 or grch38 with a variant in any
    spelling. A position gives the smallest rs number there, and says so where there are more; its ALT is kept where it is one of those
    known, else the first known one. state is resolved, not_found, or malformed. Equi joins throughout: a dimension of any size.
    """
    from ..functions.text import canonical_variant, rsid, variant_parts

    number = lambda x: F.substr(x, F.lit(3)).cast("long")
    asked = asked.withColumn("_v", F.when(F.col("kind") != "rsid", variant_parts("value"))).withColumn("_rs", F.when((F.col("kind") == "rsid") & F.trim("value").rlike(r"^(?i)rs\d+$"), rsid("value")))
    places = known.select("build", "chrom", "pos", "rsid").distinct().groupBy("build", "chrom", "pos").agg(F.min_by("rsid", number("rsid")).alias("_at"), F.count("*").alias("_n"))
    # Both tables grow with what is known, whatever size is estimated of them: they are merged, never broadcast. Rows without a key match
    # nothing, and are dealt over all tasks by their id.
    on = [F.col("kind") == F.col("build"), F.col("_v.chrom") == F.col("chrom"), F.coalesce(F.col("_v.pos"), F.xxhash64("id")) == F.col("pos")]
    found = asked.join(places.hint("merge"), on, "left").withColumn("rsid", F.coalesce("_rs", "_at")).drop("build", "chrom", "pos")
    of = lambda b: F.max(F.when(F.col("build") == b, F.struct("chrom", "pos"))).alias(f"_{b}")
    # ref and alts of the newer build, as far as it has the number.
    newest = F.max_by(F.struct("ref", "alts"), "build").alias("_r")
    dim = known.groupBy("rsid").agg(of("grch37"), of("grch38"), newest)
    dim = dim.withColumnRenamed("rsid", "_key").withColumn("_deal", F.xxhash64("_key"))
    out = found.join(dim.hint("merge"), [F.col("rsid") == F.col("_key"), F.xxhash64(F.coalesce("rsid", F.col("id").cast("string"))) == F.col("_deal")], "left")
    alts, ref = F.col("_r.alts"), F.col("_r.ref")
    alt = F.when(F.array_contains(alts, F.col("_v.alt")), F.col("_v.alt")).otherwise(F.coalesce(F.get(alts, F.lit(0)), F.col("_v.alt")))
    said = lambda when, *parts: F.when(when, F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts]))
    warnings = F.array_compact(
        F.array(
            said(F.col("_n") > 1, F.col("_n").cast("string"), " rs numbers at this place"),
            said(F.col("_v.ref") != ref, "ref ", F.col("_v.ref"), " isn't ", ref),
            said((F.size(alts) > 0) & ~F.array_contains(alts, F.col("_v.alt")), "alt ", F.col("_v.alt"), " isn't known"),
            said(F.col("_key").isNotNull() & F.col("_grch37").isNull(), "no place in grch37"),
            said(F.col("_key").isNotNull() & F.col("_grch38").isNull(), "no place in grch38"),
        )
    )
    malformed = F.when(F.col("kind") == "rsid", F.col("_rs").isNull()).when(F.col("kind").isin("grch37", "grch38"), F.col("_v").isNull()).otherwise(True)
    state = F.when(malformed, "malformed").when(F.col("_key").isNull(), "not_found").otherwise("resolved")
    name = lambda b: canonical_variant(F.col(f"_{b}.chrom"), F.col(f"_{b}.pos"), ref, alt).alias(b)
    return out.select("id", F.col("_key").alias("rsid"), name("grch37"), name("grch38"), state.alias("state"), F.when(F.col("_key").isNotNull(), F.coalesce(warnings, F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>")).alias("warnings"))


def truth_benchmark(truth: DataFrame, depth: DataFrame, calls: DataFrame, least: int = 10, flank: int = 100, tolerance: int = 50, width: int = 1024) -> tuple[DataFrame, DataFrame]:
    """The benchmark of calls against truth, and the intervals that it looks at.

    truth and calls have (contig, pos, ref, alt, and for calls filter), depth (contig, pos, tumor, normal). Truth is covered where both samples
    are `least` deep; covered places with `flank` bases on each side are merged with a tolerance; passing calls within these
    intervals are held against covered truth for recall, and against all truth for precision.
    """
    from .intervals import points_in_ranges
    from ..sources.tables import checkpointed
    from .relational import overlap, recall_precision
    from .windows import merge_intervals

    keys = ["contig", "pos", "ref", "alt"]
    deep = depth.filter((F.col("tumor") >= least) & (F.col("normal") >= least)).select("contig", "pos").distinct()
    # Both are read several times, and made once: files are read and intervals merged a single time.
    covered = checkpointed(truth.select(*keys).distinct().join(deep, ["contig", "pos"]))
    around = covered.select("contig", F.greatest(F.col("pos") - 1 - flank, F.lit(0)).alias("start"), (F.col("pos") + flank).alias("end"))
    looked = checkpointed(merge_intervals(around, tolerance=tolerance).select("contig", "start", "end"))
    seen = points_in_ranges(calls.filter(F.col("filter") == "PASS").select(*keys), looked, "contig", "pos", "start", "end", width, one_based=True)
    return recall_precision(overlap(seen, truth.select(*keys), covered, keys)), looked


def simple_quality(x: Column) -> Column:
    """Mean Phred quality of a quality string (offset 33)."""
    codes = F.transform(F.filter(F.split(x, ""), lambda s: s != ""), F.ascii)
    return F.aggregate(codes, F.lit(0), lambda a, c: a + c) / F.size(codes) - 33
