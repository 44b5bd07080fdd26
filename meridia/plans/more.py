"""Predicates, ladders, joins, orders and scalars that the other plan modules don't show, over the driver tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates, numeric, rules, text
from ..functions import json as js
from ..operators import genomics as ops
from ..operators import intervals, relational, windows
from ..sources import genomics, sinks
from .files import _lines, _place, _tabs
from .registry import query, table

KEY = ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
KEYS = ", ".join(KEY)


@query("""
SELECT p_partkey, CASE p_size % 5 WHEN 0 THEN NULL WHEN 1 THEN NULL ELSE p_size::DOUBLE END AS finite, p_retailprice AS first_number, p_size % 3 = 0 AS is_id FROM part""")
def p07_coercions(spark: SparkSession, sf: str) -> DataFrame:
    """Blanks, NaN and text to null; the first number in a text; digits only."""
    p = table(spark, sf, "part")
    raw = F.when(F.col("p_size") % 5 == 0, "").when(F.col("p_size") % 5 == 1, "NaN").otherwise(F.col("p_size").cast("string"))
    tag = F.when(F.col("p_size") % 3 == 0, F.concat(F.lit(" "), "p_size", F.lit(" "))).otherwise("7q")
    return p.select("p_partkey", numeric.finite(raw).alias("finite"), numeric.first_number(F.concat(F.lit("costs "), F.format_number("p_retailprice", 2), F.lit(" USD 5"))).alias("first_number"), F.trim(tag).rlike("^[0-9]+$").alias("is_id"))


@query("SELECT 'chr' || range AS contig FROM range(1, 23) WHERE range NOT IN (SELECT l_linenumber FROM lineitem)")
def p06_missing_autosomes(spark: SparkSession, sf: str) -> DataFrame:
    """Autosomes that don't occur."""
    seen = table(spark, sf, "lineitem").select(F.concat(F.lit("chr"), F.col("l_linenumber").cast("string")).alias("contig"))
    return intervals.missing_autosomes(seen, "contig", 22)


@query(f"SELECT {KEYS} FROM lineitem WHERE l_quantity >= 30 AND l_linenumber >= 4")
def p10_both_deep(spark: SparkSession, sf: str) -> DataFrame:
    """Rows deep enough on both sides (P10); the filter reaches the scan."""
    return table(spark, sf, "lineitem").filter((F.col("l_quantity") >= 30) & (F.col("l_linenumber") >= 4)).select(*KEY)


RECEPTOR_SQL = """
s AS (SELECT c_custkey, CASE c_nationkey % 4 WHEN 0 THEN 'Negative' WHEN 1 THEN 'positive' WHEN 2 THEN '' ELSE 'negative ' END AS er, CASE c_custkey % 3 WHEN 0 THEN 'negative' WHEN 1 THEN 'Equivocal' ELSE '' END AS pr, c_custkey % 50 = 0 AS called,
  CASE WHEN c_mktsegment = 'BUILDING' THEN 'BRCA_Basal' ELSE '' END AS subtype FROM customer),
r AS (SELECT *, lower(trim(er)) AS e, lower(trim(pr)) AS p FROM s),
t AS (SELECT *, CASE WHEN e = 'negative' AND p = 'negative' THEN 'xena_triple_negative' WHEN e IN ('positive', 'equivocal') OR p IN ('positive', 'equivocal') THEN 'not_tnbc_from_xena_receptor_fields' WHEN e = 'negative' OR p = 'negative' THEN 'incomplete_receptor_fields' ELSE 'no_receptor_fields_in_subset' END AS receptor FROM r)"""


@query(f"""
WITH {RECEPTOR_SQL}
SELECT c_custkey, receptor, CASE WHEN called THEN 'confirmed_from_lehmann_tcga_s1' WHEN receptor = 'not_tnbc_from_xena_receptor_fields' THEN 'not_applicable_not_tnbc_from_available_fields' WHEN receptor = 'xena_triple_negative' THEN 'needs_classifier_run_not_in_official_s1'
 WHEN subtype LIKE '%Basal%' THEN 'basal_context_but_not_official_lehmann_tnbc' ELSE 'no_call_not_in_official_lehmann_tcga_tnbc' END AS evidence FROM t""")
def p20_subtype_evidence(spark: SparkSession, sf: str) -> DataFrame:
    """Receptor status and where a subtype's evidence stands."""
    n, k = F.col("c_nationkey") % 4, F.col("c_custkey") % 3
    er = F.when(n == 0, "Negative").when(n == 1, "positive").when(n == 2, "").otherwise("negative ")
    pr = F.when(k == 0, "negative").when(k == 1, "Equivocal").otherwise("")
    c = table(spark, sf, "customer").withColumn("receptor", rules.receptor_status(er, pr))
    basal = F.when(F.col("c_mktsegment") == "BUILDING", "BRCA_Basal").otherwise("")
    return c.select("c_custkey", "receptor", rules.subtype_evidence(F.col("c_custkey") % 50 == 0, "receptor", basal, F.lit("")).alias("evidence"))


@query("""
SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'ship' WHEN 'O' THEN 'wait' ELSE 'review' END AS next_action FROM orders""")
def p21_next_action(spark: SparkSession, sf: str) -> DataFrame:
    """A lookup in a literal table with a default."""
    actions = spark.createDataFrame([("F", "ship"), ("O", "wait")], "o_orderstatus string, next_action string")
    return relational.lookup(table(spark, sf, "orders").select("o_orderkey", "o_orderstatus"), actions, ["o_orderstatus"], defaults={"next_action": "review"}).select("o_orderkey", "next_action")


@query(f"""
WITH l AS (SELECT {KEYS}, l_linenumber = 1 AS db, l_linenumber = 2 AS other, l_linenumber <= 4 AS hit, l_quantity::INT % 4 - 2 AS cna, l_tax * 5 AS fga, l_suppkey AS n FROM lineitem),
c AS (SELECT *, CASE WHEN db AND cna <= -1 AND fga >= 0.3 THEN 'positive_control' WHEN other AND cna <= -1 AND fga >= 0.25 THEN 'mechanistic_control' WHEN hit THEN 'ambiguous_control' WHEN cna = 0 AND fga <= 0.15 AND n <= 80 THEN 'negative_control' ELSE 'background' END AS category FROM l)
SELECT {KEYS}, category, round(CASE category WHEN 'positive_control' THEN 1000 + fga * 100 + cna WHEN 'mechanistic_control' THEN 800 + fga * 100 + cna WHEN 'ambiguous_control' THEN 500 + cna + fga WHEN 'negative_control' THEN 300 - fga * 100 ELSE 0 END, 4) AS score FROM c""")
def p31_panel_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Control categories and the score that ranks them."""
    li = table(spark, sf, "lineitem")
    cna, fga = F.col("l_quantity").cast("int") % 4 - 2, F.col("l_tax") * 5
    cat = rules.panel_category(F.col("l_linenumber") == 1, F.col("l_linenumber") == 2, F.col("l_linenumber") <= 4, cna, cna, cna, fga, F.col("l_suppkey"))
    return li.withColumn("category", cat).select(*KEY, "category", F.round(rules.panel_score("category", fga, cna), 4).alias("score"))


@query("""
SELECT event_id, CASE WHEN event_type = 'signup' OR value / 400 >= 0.75 THEN 'basal_like_context' WHEN user_id / 100 >= 0.75 AND value / 400 < 0.5 THEN 'lar_luminal_marker_context' WHEN event_id % 4 = 3 THEN 'immune_inflamed_context' ELSE 'mixed_or_non_basal_context' END AS context FROM events""")
def p32_expression_context(spark: SparkSession, sf: str) -> DataFrame:
    """Contexts by scores and labels."""
    named = F.when(F.col("event_type") == "signup", "BRCA_Basal")
    return table(spark, sf, "events").select("event_id", rules.rna_context(F.col("value") / 400, F.col("user_id") / 100, (F.col("event_id") % 4) / 4, named, F.lit(None).cast("string")).alias("context"))


@query(f"""
WITH l AS (SELECT {KEYS}, l_linenumber < 7 AS has, CASE l_linenumber % 3 WHEN 0 THEN 'ddr_transcription_cdk' WHEN 1 THEN 'cell_cycle_resistance' ELSE 'surface' END AS family, CASE WHEN l_tax > 0.07 THEN 'Deep Deletion' WHEN l_tax > 0.04 THEN 'gain' ELSE '' END AS cn,
  l_discount > 0.05 AS ready, l_returnflag = 'N' AS rna FROM lineitem)
SELECT {KEYS}, CASE WHEN NOT has THEN 'blocked' WHEN cn = 'Deep Deletion' THEN 'not_supported' WHEN family = 'ddr_transcription_cdk' AND (cn = 'gain' OR ready) THEN 'partial_evidence' WHEN family = 'cell_cycle_resistance' THEN 'partial_evidence'
 WHEN rna AND (cn = 'gain' OR ready) THEN 'partial_evidence' ELSE 'no_call' END AS state FROM l""")
def p34_target_states(spark: SparkSession, sf: str) -> DataFrame:
    """Target candidates, loss and disruption first."""
    k = F.col("l_linenumber") % 3
    family = F.when(k == 0, "ddr_transcription_cdk").when(k == 1, "cell_cycle_resistance").otherwise("surface")
    cn = F.when(F.col("l_tax") > 0.07, "Deep Deletion").when(F.col("l_tax") > 0.04, "gain").otherwise("")
    ready = F.when(F.col("l_discount") > 0.05, "Callable").otherwise("")
    rna = rules.rna_evidence(F.when(F.col("l_returnflag") == "N", "Detected").otherwise("?"))
    return table(spark, sf, "lineitem").select(*KEY, rules.target_state(F.col("l_linenumber") < 7, family, cn, F.lit(""), F.lit(""), ready, rna)["overall_status"].alias("state"))


@query("""
SELECT conv_id, turn, CASE WHEN length(text) = 0 OR text IS NULL THEN 'empty' WHEN contains(lower(text), 'the ') THEN 'waiting' WHEN contains(lower(text), 'une') OR contains(lower(text), 'der') THEN 'transfer' ELSE 'review' END AS state FROM conversations""")
def p36_triage(spark: SparkSession, sf: str) -> DataFrame:
    """States by words in blockers, the first that fits."""
    t = F.coalesce("text", F.lit(""))
    state = F.when(t == "", "empty").when(text.any_token_in(t, ["The "]), "waiting").when(text.any_token_in(t, ["une", "der"]), "transfer").otherwise("review")
    return table(spark, sf, "conversations").select("conv_id", "turn", state.alias("state"))


@query(f"""
SELECT {KEYS}, CASE l_returnflag WHEN 'A' THEN l_tax * 20 < 0.85 WHEN 'R' THEN l_tax * 20 > 1.05 ELSE false END AS direction, l_quantity >= 10 AND l_suppkey >= 10 AND l_discount * 5 >= 0.2 AND l_tax <= 0.05 AS somatic FROM lineitem""")
def p42_guardrails(spark: SparkSession, sf: str) -> DataFrame:
    """Copy directions and somatic guardrails."""
    way = F.when(F.col("l_returnflag") == "A", "loss").when(F.col("l_returnflag") == "R", "gain").otherwise("")
    return table(spark, sf, "lineitem").select(*KEY, rules.copy_direction(F.col("l_tax") * 20, way).alias("direction"), rules.somatic_like("l_quantity", "l_suppkey", F.col("l_discount") * 5, "l_tax").alias("somatic"))


@query("""
SELECT s_suppkey, n_name FROM supplier LEFT JOIN (SELECT upper(n_name) AS u, n_name, n_nationkey FROM nation) ON u = 'NATION_' || s_nationkey""")
def j24_other_case(spark: SparkSession, sf: str) -> DataFrame:
    """Names joined whatever their case."""
    s = table(spark, sf, "supplier").withColumn("u", F.upper(F.concat(F.lit("nation_"), F.col("s_nationkey").cast("string"))))
    return s.join(table(spark, sf, "nation").select(F.upper("n_name").alias("u"), "n_name"), "u", "left").select("s_suppkey", "n_name")


@query("""
SELECT l_suppkey, l_partkey, s_name, round(s_acctbal, 2) AS probe FROM (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem) JOIN supplier ON l_suppkey = s_suppkey""")
def j22_shared_probe(spark: SparkSession, sf: str) -> DataFrame:
    """A result computed once for each distinct key and joined to all that ask for it."""
    asked = table(spark, sf, "lineitem").select("l_suppkey", "l_partkey").distinct()
    probes = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_name", F.round("s_acctbal", 2).alias("probe"))
    return asked.join(probes, "l_suppkey")


@query("""
SELECT o.o_orderkey, (o.o_custkey = c.c_custkey AND o.o_orderkey % 5 = c.c_nationkey % 5) AS same FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey""")
def j30_identity(spark: SparkSession, sf: str) -> DataFrame:
    """Identities compared as whole structs."""
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    mine, theirs = F.struct(F.col("o_custkey").alias("a"), (F.col("o_orderkey") % 5).alias("b")), F.struct(F.col("c_custkey").alias("a"), (F.col("c_nationkey") % 5).cast("long").alias("b"))
    return o.join(c, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", mine.eqNullSafe(theirs).alias("same"))


@query("""
SELECT contig, row_number() OVER (ORDER BY o, contig) AS place FROM (SELECT DISTINCT 'chr' || CASE p_size WHEN 23 THEN 'X' WHEN 24 THEN 'Y' WHEN 25 THEN 'Un' ELSE p_size::VARCHAR END AS contig, CASE WHEN p_size <= 24 THEN p_size ELSE 999 END AS o FROM part)""")
def o02_contig_order(spark: SparkSession, sf: str) -> DataFrame:
    """Contigs in genomic order, others last."""
    s = F.col("p_size")
    name = F.concat(F.lit("chr"), F.when(s == 23, "X").when(s == 24, "Y").when(s == 25, "Un").otherwise(s.cast("string")))
    rows = table(spark, sf, "part").select(name.alias("contig")).distinct()
    return rows.withColumn("place", F.row_number().over(Window.orderBy(intervals.contig_order(F.col("contig")), "contig")).cast("long"))  # as many rows as there are contigs


@query("""
SELECT p_type, row_number() OVER (ORDER BY CASE p_type WHEN 'STANDARD' THEN 0 WHEN 'SMALL' THEN 1 ELSE 2 END, p_type) AS place FROM (SELECT DISTINCT p_type FROM part)""")
def o05_preferred_order(spark: SparkSession, sf: str) -> DataFrame:
    """Preferred labels first, then by name."""
    t = F.col("p_type")
    first = F.when(t == "STANDARD", 0).when(t == "SMALL", 1).otherwise(2)
    return table(spark, sf, "part").select("p_type").distinct().withColumn("place", F.row_number().over(Window.orderBy(first, t)).cast("long"))  # a handful of labels


@query("""
WITH s AS (SELECT user_id, list_sort(list(DISTINCT event_type)) AS seen FROM events WHERE value > 450 GROUP BY 1)
SELECT user_id, list_has_all(['click', 'error', 'view'], seen) AS subset, seen = ['click', 'view'] AS equal, len(seen)::INT AS n FROM s""")
def u05_set_tests(spark: SparkSession, sf: str) -> DataFrame:
    """Subset and equality of sets."""
    s = table(spark, sf, "events").filter("value > 450").groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("seen"))
    lit = lambda *v: F.array(*[F.lit(x) for x in v])
    return s.select("user_id", (F.size(F.array_except("seen", lit("click", "error", "view"))) == 0).alias("subset"), (F.col("seen") == lit("click", "view")).alias("equal"), F.size("seen").alias("n"))


@query("""
SELECT user_id, event_type, min(event_id) AS first_seen FROM events GROUP BY ALL""")
def u07_first_seen(spark: SparkSession, sf: str) -> DataFrame:
    """Distinct values where they first occur."""
    return table(spark, sf, "events").groupBy("user_id", "event_type").agg(F.min("event_id").alias("first_seen"))


@query("""
SELECT p_partkey, list_filter(['a', p_type, p_brand], lambda x: x <> '') AS parts, 'L' || lpad((p_size)::VARCHAR, 3, '0') AS lane, 's_RX_' || p_size || '.fq' AS signature, '2' AS mate, 'r' || p_partkey AS read_id FROM part""")
def f02_file_names(spark: SparkSession, sf: str) -> DataFrame:
    """Lists in a text, lanes, pairs and read names."""
    p = table(spark, sf, "part")
    lane = F.lpad(F.col("p_size").cast("string"), 3, "0")
    pair = text.pair_signature(F.concat(F.lit("s_R2_"), F.col("p_size").cast("string"), F.lit(".fq")))
    return p.select(
        "p_partkey",
        text.listed(F.concat(F.lit(" a ; ;"), "p_type", F.lit(" ;"), "p_brand")).alias("parts"),
        text.lane_token(F.concat(F.lit("d/x_L"), lane, F.lit("_R1.gz")), F.lit(1)).alias("lane"),
        pair["signature"].alias("signature"),
        pair["mate"].alias("mate"),
        text.read_id(F.concat(F.lit("@r"), F.col("p_partkey").cast("string"), F.lit("/2 lane"))).alias("read_id"),
    )


@query("""
SELECT label, min(event_id) AS first_line FROM (SELECT event_id, unnest(CASE event_type WHEN 'error' THEN ['spot_or_host_interruption'] WHEN 'view' THEN ['report_overwrite'] WHEN 'click' THEN ['manual_or_superseded_termination', 'report_overwrite'] ELSE [] END) AS label FROM events) GROUP BY 1""")
def f14_failure_signals(spark: SparkSession, sf: str) -> DataFrame:
    """The first line of each kind of failure."""
    t = F.col("event_type")
    line = F.when(t == "error", "Host EC2 (i-1) terminated.").when(t == "view", "Report file already exists").when(t == "click", "superseded; Timeline file already exists").otherwise("fine")
    found = F.array_compact(F.array(*[F.when(line.rlike(p), F.lit(n)) for n, p in text.FAILURES]))
    return table(spark, sf, "events").select("event_id", F.explode(found).alias("label")).groupBy("label").agg(F.min("event_id").alias("first_line"))


@query("""
SELECT event_id, 'user=' || user_id || ' at chr' || (user_id % 22 + 1) || ':1,000 50%' AS line, user_id::VARCHAR AS who, 'chr' || (user_id % 22 + 1) AS chromosome, 1000::BIGINT AS position, 'a\\|b' AS cell FROM events""")
def f24_log_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines without colour codes, their key=value parts, progress and cells."""
    e = table(spark, sf, "events")
    raw = F.concat(F.lit("\x1b[32muser="), F.col("user_id").cast("string"), F.lit("  at chr"), (F.col("user_id") % 22 + 1).cast("string"), F.lit(":1,000\x1b[0m  50%\r"))
    line = text.plain_line(raw)
    at = text.progress_position(line)
    return e.select("event_id", line.alias("line"), F.element_at(text.key_values(line), "user").alias("who"), at["chromosome"].alias("chromosome"), at["position"].alias("position"), text.markdown_cell(F.lit("a|b")).alias("cell"))


@query("""
SELECT n_nationkey, CASE n_nationkey % 4 WHEN 0 THEN 'S3' WHEN 1 THEN 'Lambda' WHEN 2 THEN 'Other thing' ELSE 'EC2 other' END AS label, CASE n_nationkey % 4 WHEN 0 THEN 's3' WHEN 3 THEN 'ec2Other' ELSE 'other' END AS class, CASE n_nationkey % 2 WHEN 0 THEN 'pLoF' ELSE 'synonymous' END AS burden FROM nation""")
def f30_labels(spark: SparkSession, sf: str) -> DataFrame:
    """Short names and classes of services, one name for spellings."""
    k = F.col("n_nationkey") % 4
    name = F.when(k == 0, "Amazon Simple Storage Service").when(k == 1, "AWS Lambda").when(k == 2, "Amazon Other thing").otherwise("EC2 - Other")
    return table(spark, sf, "nation").select("n_nationkey", text.service_label(name).alias("label"), text.service_class(name).alias("class"), text.burden_set(F.when(F.col("n_nationkey") % 2 == 0, "PTV").otherwise("Syn")).alias("burden"))


@query("SELECT p_partkey, p_name || ' & ' || p_type AS scanned FROM part")
def f33_scan_form(spark: SparkSession, sf: str) -> DataFrame:
    """Texts decoded as forbidden words are looked for in them."""
    raw = F.concat(F.replace("p_name", F.lit(" "), F.lit("%2520")), F.lit(" &amp; "), F.substring("p_type", 1, 1), F.lit("​"), F.expr("substring(p_type, 2)"))
    return table(spark, sf, "part").select("p_partkey", js.scan_form(raw).alias("scanned"))


@query("""
SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS strict, o_custkey % 4 >= 2 AS settled, o_custkey % 4 < 3 AS active, ((o_custkey % 100) * 1.5)::DOUBLE AS ms FROM orders""")
def d05_time_tests(spark: SparkSession, sf: str) -> DataFrame:
    """Strict times, grace, activity and durations."""
    o = table(spark, sf, "orders")
    at = F.col("o_orderdate").cast("timestamp")
    ago = F.timestamp_seconds(F.unix_seconds(at) - (F.col("o_custkey") % 4) * 60)
    ns = (F.col("o_custkey") % 100) * 1_500_000
    return o.select("o_orderkey", F.date_format(dates.strict_utc(F.date_format(at, "yyyy-MM-dd'T'HH:mm:ss'Z'")), "yyyy-MM-dd").alias("strict"), dates.settled(at, ago).alias("settled"), dates.active(at, ago).alias("active"), dates.duration_ms(F.lit(0), ns).alias("ms"))


@query("""
SELECT p_partkey, (p_size + least(1000000, greatest(0, p_partkey - 100 - 1)) + 1)::BIGINT AS start, ceil(p_partkey / 25)::BIGINT AS bins, (p_partkey % 1000) || ' B' AS shown, round(p_retailprice / 1e6 / greatest(0.001, p_size / 10), 2) AS rate FROM part""")
def m07_sizes(spark: SparkSession, sf: str) -> DataFrame:
    """Windows inside regions, bins, shown sizes and throughput."""
    p = table(spark, sf, "part")
    return p.select("p_partkey", numeric.interior_start("p_size", "p_partkey", 100).alias("start"), numeric.bins("p_partkey", 25).alias("bins"), numeric.shown_bytes(F.col("p_partkey") % 1000).alias("shown"), numeric.throughput_mb("p_retailprice", F.col("p_size") / 10).alias("rate"))


@query("""
SELECT event_id, '{"k": ' || CAST(json_extract_string(props, '$.k') AS BIGINT) || '}' AS compact, '{}' AS cleaned, 'a~1' || event_type || '~0' AS pointer FROM events""")
def x03_json_forms(spark: SparkSession, sf: str) -> DataFrame:
    """JSON cut short, without forbidden names, and pointers."""
    return table(spark, sf, "events").select("event_id", js.compacted("props").alias("compact"), js.without_keys("props", ("K",)).alias("cleaned"), js.pointer(F.concat(F.lit("a/"), "event_type", F.lit("~"))).alias("pointer"))


@query("""
SELECT user_id, sum(CAST(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS total, count(*) AS n FROM events GROUP BY 1""")
def s65_payload_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records of staged payloads, whether a list, an object with a list, or an object alone."""
    e = table(spark, sf, "events")
    lists = e.groupBy("user_id").agg(F.concat(F.lit("["), F.array_join(F.collect_list("props"), ","), F.lit("]")).alias("j"))
    payload = F.when(F.col("user_id") % 2 == 0, F.col("j")).otherwise(F.concat(F.lit('{"results": '), "j", F.lit("}")))
    flat = lists.select("user_id", F.explode(js.records(payload)).alias("v"))
    return flat.groupBy("user_id").agg(F.sum(F.try_variant_get("v", "$.k", "bigint")).alias("total"), F.count("*").alias("n"))


@query("SELECT s_suppkey, s_name FROM supplier")
def s60_xml_rows(spark: SparkSession, sf: str) -> DataFrame:
    """XML elements as rows."""
    from ..sources.tables import xml_rows

    line = F.concat(F.lit("<row><s_suppkey>"), F.col("s_suppkey").cast("string"), F.lit("</s_suppkey><s_name>"), "s_name", F.lit("</s_name></row>"))
    return xml_rows(spark, _lines(table(spark, sf, "supplier"), line, "xml"), "row", "s_suppkey bigint, s_name string", one_a_line=True)


@query("""
WITH p AS (SELECT DISTINCT l_orderkey AS pos FROM lineitem)
SELECT pos, CASE WHEN pos = 0 THEN 'N' ELSE substr('ACGT', (((pos - 1) * (pos - 1) + (pos - 1) // 3) % 4 + 1)::INT, 1) END || substr('ACGT', ((pos * pos + pos // 3) % 4 + 1)::INT, 1) || substr('ACGT', (((pos + 1) * (pos + 1) + (pos + 1) // 3) % 4 + 1)::INT, 1) AS bases FROM p""")
def s25_reference_bases(spark: SparkSession, sf: str) -> DataFrame:
    """Bases around positions, also at the ends of chunks, from a reference in chunks with their neighbours' bases, by an equi join."""
    li = table(spark, sf, "lineitem").select(F.lit("c").alias("contig"), (F.col("l_orderkey") + 1).alias("pos")).distinct()
    base = "CASE WHEN p < 0 THEN 'N' ELSE substr('ACGT', CAST((p * p + p DIV 3) % 4 + 1 AS INT), 1) END"
    seq = F.expr(f"array_join(transform(sequence(chunk * 8 - 1, chunk * 8 + 8), p -> {base}), '')")
    chunks = li.select(F.floor((F.col("pos") - 1) / 8).alias("chunk")).distinct().select(F.lit("c").alias("contig"), "chunk", seq.alias("seq"))
    return ops.reference_base(li, chunks, 8).select((F.col("pos") - 1).alias("pos"), "bases")


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey < 40 THEN s_acctbal END AS lookup FROM supplier""")
def s77_first_symbols(spark: SparkSession, sf: str) -> DataFrame:
    """A lookup for the first forty keys only, which is what is asked for."""
    s = table(spark, sf, "supplier")
    first = s.select("s_suppkey", F.col("s_acctbal").alias("lookup")).orderBy("s_suppkey").limit(40)
    return relational.lookup(s.select("s_suppkey"), first, ["s_suppkey"])


@query("SELECT DISTINCT 'T' || n_regionkey AS sample FROM nation")
def s20_sample_names(spark: SparkSession, sf: str) -> DataFrame:
    """Sample names of a VCF header."""
    n = table(spark, sf, "nation").select("n_regionkey").distinct().agg(F.array_sort(F.collect_list(F.concat(F.lit("T"), F.col("n_regionkey").cast("string")))).alias("t"))  # five regions
    path = _lines(n, F.concat(F.lit("#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\t"), F.array_join("t", "\t")), "header")
    return genomics.vcf_samples(spark, path).select(F.explode("samples").alias("sample"))


@query("SELECT n_name, n_regionkey FROM nation")
def s40_workbook(spark: SparkSession, sf: str) -> DataFrame:
    """The first sheet of a workbook with shared strings."""

    def build(rows):
        import io
        import zipfile

        import pandas as pd

        ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
        for frame in rows:
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w") as z:
                z.writestr("xl/sharedStrings.xml", f"<sst {ns}>" + "".join(f"<si><t>{n}</t></si>" for n in frame.n_name) + "</sst>")
                cells = "".join(f'<row r="{i + 1}"><c r="A{i + 1}" t="s"><v>{i}</v></c><c r="D{i + 1}"><v>{k}</v></c></row>' for i, k in enumerate(frame.n_regionkey))
                z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData>{cells}</sheetData></worksheet>")
            yield pd.DataFrame({"path": ["book.xlsx"], "content": [out.getvalue()]})

    books = table(spark, sf, "nation").coalesce(1).mapInPandas(build, "path string, content binary")
    return genomics.workbook_rows(books).select(F.element_at("cells", "A").alias("n_name"), F.element_at("cells", "D").cast("int").alias("n_regionkey"))


@query("""
SELECT '| ' || n_nationkey || ' | ' || n_name || ' |' AS line FROM nation""")
def k11_markdown_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Rows as lines of a Markdown table (F32)."""
    n = table(spark, sf, "nation")
    return n.select(F.concat(F.lit("| "), F.concat_ws(" | ", *[text.markdown_cell(c) for c in ("n_nationkey", "n_name")]), F.lit(" |")).alias("line"))


@query("SELECT n_nationkey, n_name, 'a' AS copy FROM nation UNION ALL SELECT n_nationkey, n_name, 'b' FROM nation")
def k13_two_sinks(spark: SparkSession, sf: str) -> DataFrame:
    """The same rows to two places, then read from both."""
    n, path = table(spark, sf, "nation").select("n_nationkey", "n_name"), _place(spark, "two")
    for copy in "ab":
        sinks.write_if_changed(n, f"{path}/{copy}", ["n_nationkey"])
    both = [spark.read.parquet(f"{path}/{copy}").withColumn("copy", F.lit(copy)) for copy in "ab"]
    return both[0].unionByName(both[1])


@query("""
SELECT o_custkey, arg_max(o_orderkey, (CASE o_orderpriority WHEN '1-URGENT' THEN 2 WHEN '2-HIGH' THEN 1 ELSE 0 END, -o_orderkey)) AS best FROM orders GROUP BY 1""")
def w02_best_class(spark: SparkSession, sf: str) -> DataFrame:
    """The best class of each group, the first in input order on ties."""
    rank = F.when(F.col("o_orderpriority") == "1-URGENT", 2).when(F.col("o_orderpriority") == "2-HIGH", 1).otherwise(0)
    best = windows.best_per_group(table(spark, sf, "orders"), ["o_custkey"], [rank.desc(), F.col("o_orderkey")])
    return best.select("o_custkey", F.col("o_orderkey").alias("best"))


@query("SELECT n_nationkey, CASE WHEN n_nationkey % 4 = 0 THEN '' ELSE upper(n_name) END AS name FROM nation")
def p04_nested_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Nested fields with a default, columns dropped, strict conversions."""
    n = table(spark, sf, "nation").withColumn("gene", F.when(F.col("n_nationkey") % 4 != 0, F.struct(F.upper("n_name").alias("symbol"))))
    checked = F.when(F.col("n_nationkey") >= 0, F.col("n_nationkey")).otherwise(F.raise_error(F.lit("a negative number")).cast("int"))
    return n.select(checked.alias("n_nationkey"), F.coalesce("gene.symbol", F.lit("")).alias("name"))


@query("SELECT * FROM (VALUES ('fresh', true), ('stale', false)) t(state, current)")
def p57_currentness(spark: SparkSession, sf: str) -> DataFrame:
    """Whether all outputs are newer than the newest input, by the files' times: yes of files just written, no of the table they came from."""
    from ..sources.tables import is_current, modified

    new = modified(spark, f"{_lines(table(spark, sf, 'nation'), F.col('n_name'), 'newer')}/*.txt")
    old = modified(spark, f"{sf}/nation.parquet")
    return is_current(new, old).select(F.lit("fresh").alias("state"), "current").union(is_current(old.union(new), new).select(F.lit("stale"), "current"))


@query("SELECT l_linenumber::BIGINT AS contig, count(*) AS n FROM lineitem GROUP BY 1")
def s28_counts_by_contig(spark: SparkSession, sf: str) -> DataFrame:
    """Reads by contig as an index gives them."""
    n = table(spark, sf, "lineitem").groupBy("l_linenumber").agg(F.count("*").alias("n"))
    path = _lines(n, _tabs("l_linenumber", F.lit(1000), "n", F.lit(0)), "idxstats")
    return genomics.idxstats(spark, path).select(F.col("contig").cast("long").alias("contig"), F.col("mapped").alias("n"))


@query("""
SELECT event_id, failures::BIGINT AS failures, least(900000, 30000 * pow(2, failures - 1))::BIGINT AS wait_ms FROM (
  SELECT event_id, event_type, count(*) FILTER (event_type = 'error') OVER (PARTITION BY user_id, run ORDER BY ts, event_id) AS failures FROM (
    SELECT *, count(*) FILTER (event_type <> 'error') OVER (PARTITION BY user_id ORDER BY ts, event_id) AS run FROM events)) WHERE event_type = 'error'""")
def t11_retry_backoff(spark: SparkSession, sf: str) -> DataFrame:
    """Failures in a row and the wait before the next try."""
    from ..streaming.progress import retry_backoff

    e = table(spark, sf, "events").withColumn("failed", F.col("event_type") == "error")
    return retry_backoff(e, ["user_id"], "failed", "ts", "event_id").select("event_id", "failures", "wait_ms")


@query("""
SELECT p_partkey, round(p_size / 2, 0) AS up, round_even(p_size / 2, 0) AS even, strftime(TIMESTAMP '2024-01-01' + to_days(p_size), '%Y-%m-%d') AS day FROM part""")
def m01_rounding(spark: SparkSession, sf: str) -> DataFrame:
    """Rounding half up and half to even, and the day a ledger is kept under."""
    half = F.col("p_size") / 2
    return table(spark, sf, "part").select("p_partkey", F.round(half, 0).alias("up"), F.bround(half, 0).alias("even"), F.date_format(F.date_add(F.lit("2024-01-01").cast("date"), F.col("p_size")), "yyyy-MM-dd").alias("day"))


@query("""
SELECT c_custkey, CASE WHEN n IS NULL THEN 'absent' WHEN n > 3 THEN 'invalid' ELSE 'present' END AS state, coalesce(n, 0) || ' of 3 waiting' AS shown FROM customer LEFT JOIN (SELECT o_custkey, count(*) FILTER (o_orderstatus = 'P') AS n FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def p61_sheet_states(spark: SparkSession, sf: str) -> DataFrame:
    """Absent, invalid or present by counts of findings, with a shown metric."""
    n = table(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count_if(F.col("o_orderstatus") == "P").alias("n"))
    state = F.when(F.col("n").isNull(), "absent").when(F.col("n") > 3, "invalid").otherwise("present")
    out = relational.lookup(table(spark, sf, "customer").select("c_custkey"), n, ["c_custkey"])
    return out.select("c_custkey", state.alias("state"), F.format_string("%d of 3 waiting", F.coalesce("n", F.lit(0))).alias("shown"))


@query("SELECT 'number of ' || p_type AS key, count(*)::DOUBLE AS value FROM part GROUP BY 1")
def s19_summary_numbers(spark: SparkSession, sf: str) -> DataFrame:
    """The SN lines of a variant summary."""
    n = table(spark, sf, "part").groupBy("p_type").agg(F.count("*").alias("n"))
    line = _tabs(F.lit("SN"), F.lit(0), F.concat(F.lit("number of "), "p_type", F.lit(":")), "n")
    return genomics.summary_numbers(spark, _lines(n, line, "stats"))
