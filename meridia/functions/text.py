"""String functions over Columns: names, identifiers, read ids, variants, tokens and log lines. All stay in the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnLike = Column | str


def _c(x: ColumnLike) -> Column:
    return F.col(x) if isinstance(x, str) else x


def slug(x: ColumnLike) -> Column:
    """Lower case, other signs than letters and digits as single underscores, none at the ends."""
    return F.regexp_replace(F.regexp_replace(F.lower(_c(x)), "[^a-z0-9]+", "_"), "^_+|_+$", "")


def listed(x: ColumnLike, sep: str = ";") -> Column:
    """The trimmed, non-blank parts of a separated list."""
    return F.filter(F.transform(F.split(_c(x), sep), lambda v: F.trim(v)), lambda v: v != "")


def safe_token(x: ColumnLike, default: str = "sample") -> Column:
    """Letters and digits joined by underscores, or the default."""
    out = F.regexp_replace(F.regexp_replace(_c(x), "[^A-Za-z0-9]+", "_"), "^_+|_+$", "")
    return F.when(out == "", F.lit(default)).otherwise(out)


def lane_token(path: ColumnLike, fallback: ColumnLike) -> Column:
    """L### from a file name's _L###_ part, else pair## from the fallback number."""
    lane = F.regexp_extract(F.element_at(F.split(_c(path), "/"), -1), r"_L(\d{3})_", 1)
    return F.when(lane != "", F.concat(F.lit("L"), lane)).otherwise(F.concat(F.lit("pair"), F.lpad(_c(fallback).cast("string"), 2, "0")))


def pair_signature(path: ColumnLike) -> Column:
    """struct(signature, mate) of a paired read file's name, null when none of the three spellings fits.

    The last spelling takes a plain dot, so that `x_R1.fastq.gz` pairs up.
    """
    p = _c(path)
    spellings = ((r"(?i)^(.*)reads([12])(.*)$", "readsX"), (r"^(.*)_R([12])_(.*)$", "_RX_"), (r"^(.*)_R([12])\.(.*)$", "_RX."))
    out = None
    for pattern, shown in reversed(spellings):
        found = F.struct(F.concat(F.regexp_extract(p, pattern, 1), F.lit(shown), F.regexp_extract(p, pattern, 3)).alias("signature"), F.regexp_extract(p, pattern, 2).alias("mate"))
        out = F.when(p.rlike(pattern), found) if out is None else F.when(p.rlike(pattern), found).otherwise(out)
    return out


def read_id(x: ColumnLike) -> Column:
    """A read's name without the leading @, what follows a blank, and the mate's suffix."""
    return F.regexp_replace(F.element_at(F.split(F.regexp_replace(_c(x), "^@+", ""), r"\s"), 1), "/[12]$", "")


def reverse_complement(x: ColumnLike) -> Column:
    """Of a DNA string; signs other than A, C, G and T become N."""
    return F.reverse(F.translate(F.regexp_replace(F.upper(_c(x)), "[^ACGT]", "N"), "ACGT", "TGCA"))


def pyrimidine_context(context: ColumnLike, ref: ColumnLike, alt: ColumnLike) -> Column:
    """A[C>T]G form of a three-base context on the strand where REF is C or T; null for other than single A, C, G, T."""
    c, r, a = F.upper(_c(context)), F.upper(_c(ref)), F.upper(_c(alt))
    ok = c.rlike("^[ACGT]{3}$") & r.rlike("^[ACGT]$") & a.rlike("^[ACGT]$") & (r != a)
    flip = ~r.isin("C", "T")
    c2, r2, a2 = (F.when(flip, reverse_complement(x)).otherwise(x) for x in (c, r, a))
    return F.when(ok, F.concat(F.substring(c2, 1, 1), F.lit("["), r2, F.lit(">"), a2, F.lit("]"), F.substring(c2, 3, 1)))


def coalesced_text(*cols: ColumnLike) -> Column:
    """The first of several spellings of a field that isn't blank."""
    return F.coalesce(*[F.nullif(F.trim(_c(c)), F.lit("")) for c in cols])


INDELS = "[+-](?:" + "|".join(f"{k}[^0-9].{{0,{k - 1}}}" for k in range(1, 100)) + ")"


def pileup_counts(bases: ColumnLike, ref: ColumnLike, alt: ColumnLike) -> Column:
    """struct(ref, alt, other, deletion, skip) of a pileup's base string.

    Read starts take a quality sign with them, and an indel as many bases as it says. Patterns run only on strings that hold a start or an
    indel; lengths up to 99 are alternatives of one pattern, and strings with longer indels are folded sign by sign.
    """
    r, a = F.upper(_c(ref)), F.upper(_c(alt))
    whole = _c(bases)
    started = F.when(F.contains(whole, F.lit("^")), F.regexp_replace(whole, r"(?s)\^.", "")).otherwise(whole)
    indel = F.contains(whole, F.lit("+")) | F.contains(whole, F.lit("-"))
    bare = F.upper(F.when(indel, F.regexp_replace(started, INDELS, "")).otherwise(started))
    only = lambda signs: F.length(bare) - F.length(F.translate(bare, signs, ""))
    named = lambda b: F.length(bare) - F.length(F.replace(bare, b, F.lit("")))
    n_ref, n_alt = named(r), F.when(a == r, 0).otherwise(named(a))
    fast = F.struct((only(".,") + n_ref).alias("ref"), n_alt.alias("alt"), (only("ACGTN") - n_ref - n_alt).alias("other"), only("*#").alias("deletion"), only("<>").alias("skip"))
    return F.when(indel & whole.rlike("[+-][0-9]{3}"), _pileup_fold(bases, r, a)).otherwise(fast)


def _pileup_fold(bases: ColumnLike, r: Column, a: Column) -> Column:
    signs = F.filter(F.split(_c(bases), ""), lambda s: s != "")
    start = F.struct(*[F.lit(0).alias(k) for k in ("ref", "alt", "other", "deletion", "skip", "jump")], F.lit(-1).alias("number"))

    def step(s: Column, ch: Column) -> Column:
        digit = ch.rlike("^[0-9]$")
        reading = (s.number >= 0) & digit
        indel_ends = (s.number >= 0) & ~digit
        jump = F.when(indel_ends, s.number).otherwise(s.jump)
        eaten = (jump > 0) & ~reading
        live = ~reading & ~eaten
        base = F.upper(ch)
        hit = {
            "ref": live & (ch.isin(".", ",") | (base == r)),
            "alt": live & (base == a) & (base != r),
            "other": live & base.isin("A", "C", "G", "T", "N") & (base != r) & (base != a),
            "deletion": live & ch.isin("*", "#"),
            "skip": live & ch.isin("<", ">"),
        }
        return F.struct(
            *[(s[k] + F.when(v, 1).otherwise(0)).alias(k) for k, v in hit.items()],
            F.when(live & (ch == "^"), 1).when(eaten, jump - 1).when(reading, s.jump).otherwise(0).alias("jump"),
            F.when(reading, s.number * 10 + ch.try_cast("int")).when(live & ch.isin("+", "-"), 0).otherwise(-1).alias("number"),
        )

    return F.aggregate(signs, start, step, lambda s: F.struct(*[s[k].alias(k) for k in ("ref", "alt", "other", "deletion", "skip")]))


#: Seconds of each unit in a trace's durations.
UNITS = {"ms": 0.001, "s": 1.0, "m": 60.0, "h": 3600.0, "d": 86400.0}


def duration_seconds(x: ColumnLike) -> Column:
    """Seconds of `1h 2m 3.5s 4ms`; null where no part has a unit."""
    pattern = r"(\d+(?:\.\d+)?)(ms|s|m|h|d)\b"
    amounts = F.regexp_extract_all(_c(x), F.lit(pattern), F.lit(1))
    units = F.regexp_extract_all(_c(x), F.lit(pattern), F.lit(2))
    scale = F.create_map(*[y for k, v in UNITS.items() for y in (F.lit(k), F.lit(v))])
    total = F.aggregate(F.zip_with(amounts, units, lambda a, u: a.cast("double") * F.element_at(scale, u)), F.lit(0.0), lambda s, v: s + v)
    return F.when(F.size(amounts) > 0, total)


def shown_duration(seconds: ColumnLike) -> Column:
    """`1h 2m 3s` of a number of seconds, rounded half to even; blank for null."""
    n = F.bround(_c(seconds), 0).cast("long")
    h, m, s = F.floor(n / 3600), F.floor(F.pmod(n, F.lit(3600)) / 60), F.pmod(n, F.lit(60))
    out = F.when(h > 0, F.format_string("%dh %dm %ds", h, m, s)).when(m > 0, F.format_string("%dm %ds", m, s)).otherwise(F.format_string("%ds", s))
    return F.when(_c(seconds).isNull(), F.lit("")).otherwise(out)


def first_match(x: ColumnLike, rules: list[tuple[str, str]], default: str | None = None, ignore_case: bool = False) -> Column:
    """The label of the first rule (label, pattern) whose pattern is found."""
    out = F.lit(default)
    for label, pattern in reversed(rules):
        out = F.when(_c(x).rlike(("(?i)" if ignore_case else "") + pattern), F.lit(label)).otherwise(out)
    return out


#: Names of processes in a trace, and what each line of a failed run's log says.
STAGES = [
    ("phase3_fetch", "PHASE3_FETCH_WORKSPACE|PHASE3_FETCH "),
    ("reference_index", "PHASE3_REFERENCE_INDEX"),
    ("align_tumor", "PHASE3_ALIGN_SAMPLE.*align_tumor|align_tumor.*PHASE3_ALIGN_SAMPLE"),
    ("align_normal", "PHASE3_ALIGN_SAMPLE.*align_normal|align_normal.*PHASE3_ALIGN_SAMPLE"),
    ("align_sample", "PHASE3_ALIGN_SAMPLE"),
    ("downstream", "PHASE3_DOWNSTREAM"),
    ("sra_benchmark", "PHASE3_SRA_BENCHMARK"),
    ("phase3_monolith", r"PHASE3_WGS \("),
]
FAILURES = [
    ("spot_or_host_interruption", "Host EC2 .* terminated"),
    ("aws_credentials_metadata", "Error when retrieving credentials from container-role"),
    ("duplicate_alignment_resume", "Terminate duplicate .* alignment"),
    ("manual_or_superseded_termination", r"\bsuperseded\b|Killing running tasks"),
    ("report_overwrite", "(Report|Timeline) file already exists"),
    ("missing_cloudwatch_stream", "Unable to find CloudWatch log stream"),
]
SEVERITIES = [
    ("error", r"\b(error|fatal|failed|failure|exception)\b"),
    ("warning", r"\b(warn|warning|retry|degraded)\b"),
    ("success", r"\b(ok|passed|success|succeeded|complete|completed)\b"),
    ("info", r"\b(info|debug|trace|running|started|start)\b"),
]


def stage_name(x: ColumnLike) -> Column:
    """The stage that a process name belongs to."""
    return first_match(x, STAGES, "other")


def severity(x: ColumnLike) -> Column:
    """error, warning, success or info by the words of a line; null where none is found."""
    return first_match(F.lower(_c(x)), SEVERITIES)


def event_category(name: ColumnLike, level: ColumnLike) -> Column:
    """The category of a structured event by its severity and name."""
    n, s = F.lower(_c(name)), _c(level)
    return (
        F.when(s == "error", "error")
        .when(s == "warning", "warning")
        .when(n.rlike("progress|heartbeat|meter"), "progress")
        .when(n.rlike(r"artifact|output|upload|cache\.reuse|cache_hit"), "artifact")
        .when(n.rlike(r"command|process|task|span\.start|run\.start"), "process")
        .when((s == "success") | n.rlike(r"span\.end|run\.end"), "success")
        .otherwise("info")
    )


def variant_parts(x: ColumnLike) -> Column:
    """struct(chrom, pos, ref, alt) of `chr1:123-A-T` with any separators; null if malformed. M is MT."""
    p = F.filter(F.split(F.trim(_c(x)), r"[\s:_/>|,;-]+"), lambda v: v != "")
    chrom = F.upper(F.regexp_extract(F.get(p, F.lit(0)), r"(?i)^(?:chr)?([0-9]{1,2}|X|Y|M|MT)$", 1))
    pos = F.get(p, F.lit(1)).try_cast("long")
    ref, alt = F.upper(F.get(p, F.lit(2))), F.upper(F.get(p, F.lit(3)))
    ok = (F.size(p) == 4) & (chrom != "") & (pos > 0) & ref.rlike("^[ACGTN]+$") & alt.rlike("^[ACGTN]+$")
    return F.when(ok, F.struct(F.when(chrom == "M", F.lit("MT")).otherwise(chrom).alias("chrom"), pos.alias("pos"), ref.alias("ref"), alt.alias("alt")))


def canonical_variant(chrom: ColumnLike, pos: ColumnLike, ref: ColumnLike, alt: ColumnLike) -> Column:
    """chrom:pos-ref-alt."""
    return F.concat(_c(chrom), F.lit(":"), _c(pos).cast("string"), F.lit("-"), _c(ref), F.lit("-"), _c(alt))


def eqtl_variant_id(chrom: ColumnLike, pos: ColumnLike, ref: ColumnLike, alt: ColumnLike, build: str = "b38") -> Column:
    """chr1_123_A_T_b38."""
    return F.concat_ws("_", F.concat(F.lit("chr"), _c(chrom)), _c(pos).cast("string"), _c(ref), _c(alt), F.lit(build))


def rsid(x: ColumnLike) -> Column:
    """The first rs number of a text, lower-case; null if there is none."""
    return F.nullif(F.lower(F.regexp_extract(_c(x), r"(?i)(rs\d+)", 1)), F.lit(""))


def words_only(x: ColumnLike) -> Column:
    """Lower case, other signs than letters and digits as single blanks, trimmed."""
    return F.trim(F.regexp_replace(F.lower(_c(x)), "[^a-z0-9]+", " "))


#: Words too common to tell one term from another.
STOP_WORDS = ("and", "are", "for", "from", "into", "not", "other", "the", "with", "without")


def tokens(x: ColumnLike) -> Column:
    """Distinct words of three signs and more, without stop words."""
    return F.array_distinct(F.filter(F.regexp_extract_all(F.lower(_c(x)), F.lit("[a-z0-9]+"), F.lit(0)), lambda t: (F.length(t) > 2) & ~t.isin(*STOP_WORDS)))


def lexical_score(text: ColumnLike, term: ColumnLike) -> Column:
    """1 if the text holds the term, else 0.6 of the term's and 0.4 of the text's share of common words, 0.1 more for two and more."""
    a, b = words_only(text), words_only(term)
    ta, tb = tokens(text), tokens(term)
    both = F.size(F.array_intersect(ta, tb))
    score = both / F.greatest(F.size(tb), F.lit(1)) * 0.6 + both / F.greatest(F.size(ta), F.lit(1)) * 0.4 + F.when(both >= 2, 0.1).otherwise(0.0)
    return F.when((a == "") | (b == ""), 0.0).when(F.contains(a, b), 1.0).when(both == 0, 0.0).otherwise(F.least(F.lit(1.0), score))


def refseq_chromosome(x: ColumnLike) -> Column:
    """1 to 22, X, Y or MT of an NC_ accession; null for others."""
    n = F.regexp_extract(_c(x), r"^NC_0*(\d+)(?:\.\d+)?$", 1).try_cast("int")
    return F.when(n == 23, "X").when(n == 24, "Y").when(n == 12920, "MT").when(n.between(1, 22), n.cast("string"))


def burden_set(x: ColumnLike) -> Column:
    """One name for each spelling of a burden set."""
    low = F.lower(F.trim(_c(x)))
    return F.when(low.isin("lof", "plof", "ptv"), "pLoF").when(low.isin("missense", "missenselc", "missense|lc", "missense_lc"), "missense|LC").when(low.isin("synonymous", "syn"), "synonymous").otherwise(_c(x))


def plain_line(x: ColumnLike) -> Column:
    """A log line without colour codes, carriage returns and runs of blanks."""
    return F.trim(F.regexp_replace(F.regexp_replace(_c(x), r"\x1B\[[0-9;?]*[ -/]*[@-~]|\r", ""), r"\s+", " "))


def key_values(x: ColumnLike) -> Column:
    """map of the key=value parts of a line; values may be quoted, the last of a repeated key stays."""
    pattern = r"""\b([A-Za-z][A-Za-z0-9_.-]*)=("[^"]*"|'[^']*'|[^\s,]+)"""
    keys = F.regexp_extract_all(_c(x), F.lit(pattern), F.lit(1))
    values = F.transform(F.regexp_extract_all(_c(x), F.lit(pattern), F.lit(2)), lambda v: F.regexp_replace(F.regexp_replace(v, "^[\"']|[\"']$", ""), "[.;]$", ""))
    pairs = F.zip_with(keys, values, lambda k, v: F.struct(k.alias("k"), v.alias("v")))
    return F.aggregate(pairs, F.expr("CAST(map() AS MAP<STRING, STRING>)"), lambda m, e: F.map_concat(F.map_filter(m, lambda k, _: k != e.k), F.create_map(e.k, e.v)))


#: What each kind of line looks like; the first that fits names it.
LINE_KINDS = [
    ("json", r"^\{.*\}$"),
    ("gatk", r"(?i)ProgressMeter|\bgatk\b"),
    ("nextflow", r"(?i)^executor >|\bnextflow\b|^\[[0-9a-f]{2}/[0-9a-f]{6}\]"),
    ("error", r"(?i)\b(error|fatal|exception|traceback)\b"),
    ("warning", r"(?i)\bwarn(ing)?\b"),
    ("step", r"(?i)^(\[[^\]]+\]\s*)?step\b"),
    ("runtime_stage", r"(?i)\b(stage|phase)[=: ]"),
    ("heartbeat", r"(?i)\bheartbeat\b|\bshard\b"),
    ("command", r"^(\+|\$)\s|(?i)\bcommand[=:]"),
    ("artifact", r"(?i)\b(wrote|written|uploaded|artifact|output)\b"),
    ("success", r"(?i)\b(success|succeeded|completed?|passed)\b"),
]


def line_kind(x: ColumnLike) -> Column:
    """Which of eleven readers a log line belongs to, else info."""
    return first_match(plain_line(x), LINE_KINDS, "info")


def progress_position(x: ColumnLike) -> Column:
    """struct(chromosome, position, percent) of a progress line; null if it has none."""
    chrom = F.regexp_extract(_c(x), r"\b(chr(?:[0-9]{1,2}|X|Y|M)):([0-9,]+)", 1)
    pos = F.replace(F.regexp_extract(_c(x), r"\b(chr(?:[0-9]{1,2}|X|Y|M)):([0-9,]+)", 2), F.lit(","), F.lit("")).try_cast("long")
    pct = F.regexp_extract(_c(x), r"([0-9]+(?:\.[0-9]+)?)\s*%", 1).try_cast("double")
    return F.when(chrom != "", F.struct(chrom.alias("chromosome"), pos.alias("position"), F.when(pct <= 100, pct).alias("percent")))


#: Short names of billed services, and the class each is counted under.
SERVICES = {
    "Amazon Simple Storage Service": ("S3", "s3"),
    "Amazon Elastic Compute Cloud - Compute": ("EC2 compute", "ec2Compute"),
    "EC2 - Other": ("EC2 other", "ec2Other"),
    "AWS Key Management Service": ("KMS", "networkSecurity"),
    "Amazon Virtual Private Cloud": ("VPC", "networkSecurity"),
    "AWS Cost Explorer": ("Cost Explorer", "costExplorer"),
    "Amazon EC2 Container Registry (ECR)": ("ECR", "other"),
    "AWS Lambda": ("Lambda", "other"),
    "Amazon DynamoDB": ("DynamoDB", "other"),
    "Amazon Simple Notification Service": ("SNS", "other"),
    "AmazonCloudWatch": ("CloudWatch", "other"),
}


def service_label(x: ColumnLike) -> Column:
    """A billed service's short name."""
    names = F.create_map(*[F.lit(y) for k, v in SERVICES.items() for y in (k, v[0])])
    return F.coalesce(F.element_at(names, _c(x)), F.regexp_replace(F.regexp_replace(_c(x), "^Amazon ", ""), "^AWS ", ""))


def service_class(x: ColumnLike) -> Column:
    """The cost class of a billed service."""
    names = F.create_map(*[F.lit(y) for k, v in SERVICES.items() for y in (k, v[1])])
    return F.coalesce(F.element_at(names, _c(x)), F.lit("other"))


def s3_parts(uri: ColumnLike) -> Column:
    """struct(bucket, key) of s3://bucket/key; null for others."""
    bucket = F.regexp_extract(_c(uri), "^s3://([^/]+)/?(.*)$", 1)
    return F.when(bucket != "", F.struct(bucket.alias("bucket"), F.regexp_extract(_c(uri), "^s3://([^/]+)/?(.*)$", 2).alias("key")))


def markdown_cell(x: ColumnLike) -> Column:
    """A value fit for a cell of a Markdown table."""
    return F.regexp_replace(F.replace(F.coalesce(_c(x).cast("string"), F.lit("")), F.lit("|"), F.lit("\\|")), r"\r?\n", " ")


def event_key(*cols: ColumnLike) -> Column:
    """sha256 over the fields' texts with NUL between them, nulls as blanks."""
    return F.sha2(F.concat_ws("\u0000", *[F.coalesce(_c(c).cast("string"), F.lit("")) for c in cols]), 256)


def wildcard_free(x: ColumnLike, needle: ColumnLike) -> Column:
    """Whether the text holds the needle, whatever the case; % and _ stand for themselves."""
    return F.contains(F.lower(_c(x)), F.lower(_c(needle)))


def all_words_in(x: ColumnLike, query: ColumnLike) -> Column:
    """Whether every word of the query is in the text, both in words only."""
    text = words_only(x)
    return F.forall(F.filter(F.split(words_only(query), " "), lambda t: t != ""), lambda t: F.contains(text, t))


def any_token_in(x: ColumnLike, needles: list[str]) -> Column:
    """Whether the lower-cased text holds one of the needles."""
    low = F.lower(_c(x))
    return F.exists(F.array(*[F.lit(n.lower()) for n in needles]), lambda n: F.contains(low, n))
