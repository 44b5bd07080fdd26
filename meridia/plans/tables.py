"""Joins, set operations, aggregates and windows over the star schema, as the tabular analogues of panel and benchmark queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import numeric, rules, text
from ..operators import aggregates, relational, windows
from .registry import query, table

CLASS_SQL = "CASE WHEN o_totalprice >= 300000 THEN 'high' WHEN o_totalprice >= 100000 THEN 'middle' ELSE 'low' END"


def _class() -> F.Column:
    return F.when(F.col("o_totalprice") >= 300000, "high").when(F.col("o_totalprice") >= 100000, "middle").otherwise("low")


@query(f"""
WITH r AS (SELECT c.c_custkey, n.n_name, o.o_orderkey, o.o_totalprice, {CLASS_SQL} AS price_class, o.o_orderpriority,
  row_number() OVER (PARTITION BY o.o_custkey ORDER BY o.o_totalprice DESC, o.o_orderkey) AS rn
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey)
SELECT c_custkey, n_name, o_orderkey, o_totalprice, price_class, o_orderpriority FROM r WHERE rn = 1""")
def flagship_best_order(spark: SparkSession, sf: str) -> DataFrame:
    """Scan, left joins, class ladder and the best row of each group."""
    best = windows.best_per_group(table(spark, sf, "orders"), ["o_custkey"], [F.col("o_totalprice").desc(), F.col("o_orderkey")])
    rows = best.join(table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey"))
    rows = relational.lookup(rows.withColumnRenamed("c_nationkey", "n_nationkey"), table(spark, sf, "nation").select("n_nationkey", "n_name"), ["n_nationkey"])
    return rows.select("c_custkey", "n_name", "o_orderkey", "o_totalprice", _class().alias("price_class"), "o_orderpriority")


@query(f"SELECT o_orderpriority AS expected, {CLASS_SQL} AS predicted, count(*) AS n FROM orders GROUP BY ALL")
def a13_confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Two-key counts."""
    return aggregates.confusion(table(spark, sf, "orders"), F.col("o_orderpriority"), _class())


@query("""
WITH last AS (SELECT o_custkey, arg_max(o_orderstatus, o_orderkey) AS status, arg_max(o_totalprice, o_orderkey) AS price FROM orders GROUP BY 1)
SELECT c_custkey, coalesce(status, '') AS status, coalesce(price, 0) AS price FROM customer LEFT JOIN last ON c_custkey = o_custkey""")
def j01_lookup_last_wins(spark: SparkSession, sf: str) -> DataFrame:
    """A left lookup in which the last of repeated keys counts, with defaults."""
    right = table(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), "o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("price"))
    return relational.lookup(table(spark, sf, "customer").select("c_custkey"), right, ["c_custkey"], "o_orderkey", {"status": "", "price": 0.0}).select("c_custkey", "status", "price")


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def j05_must_match(spark: SparkSession, sf: str) -> DataFrame:
    """An inner join that fails where a partner is missing."""
    right = table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey")
    return relational.must_match(table(spark, sf, "nation"), right, ["n_regionkey"], "region").select("n_nationkey", "n_name", "r_name")


@query("""
SELECT o_orderkey, coalesce(p.p_name, q.p_name) AS p_name FROM orders LEFT JOIN part p ON o_orderkey = p.p_partkey LEFT JOIN part q ON o_custkey = q.p_partkey""")
def j17_lookup_by_either_key(spark: SparkSession, sf: str) -> DataFrame:
    """By the first key, else by the second."""
    o, p = table(spark, sf, "orders").select("o_orderkey", "o_custkey"), table(spark, sf, "part").select("p_partkey", "p_name")
    return relational.lookup_by_either(o, p, ("o_orderkey", "p_partkey"), ("o_custkey", "p_partkey"), "p_name").select("o_orderkey", "p_name")


OVERLAP_SQL = """
calls AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_totalprice > 200000),
truth AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')),
covered AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderpriority IN ('1-URGENT', '2-HIGH') AND o_orderstatus <> 'P')"""


def _overlap(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").withColumn("k", F.col("o_orderkey"))
    truth = o.filter(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"))
    return relational.overlap(o.filter("o_totalprice > 200000"), truth, truth.filter("o_orderstatus <> 'P'"), ["k"])


@query(f"""
WITH {OVERLAP_SQL}
SELECT k, 'tp' AS cls FROM calls WHERE k IN (FROM covered) UNION ALL
SELECT k, 'outside' FROM calls WHERE k IN (FROM truth) AND k NOT IN (FROM covered) UNION ALL
SELECT k, 'fp' FROM calls WHERE k NOT IN (FROM truth) UNION ALL SELECT k, 'fn' FROM covered WHERE k NOT IN (FROM calls)""")
def j13_truth_overlap(spark: SparkSession, sf: str) -> DataFrame:
    """True and false positives, false negatives and calls outside covered truth."""
    return _overlap(spark, sf)


@query(f"""
WITH {OVERLAP_SQL}, n AS (SELECT (SELECT count(*) FROM calls WHERE k IN (FROM covered)) AS tp, (SELECT count(*) FROM calls WHERE k NOT IN (FROM truth)) AS fp,
  (SELECT count(*) FROM covered WHERE k NOT IN (FROM calls)) AS fn, (SELECT count(*) FROM calls WHERE k IN (FROM truth) AND k NOT IN (FROM covered)) AS outside)
SELECT tp, fp, fn, outside, round(tp / (tp + fn), 4) AS recall, round(tp / (tp + fp), 4) AS precision FROM n""")
def a15_recall_precision(spark: SparkSession, sf: str) -> DataFrame:
    """Recall over covered truth, precision against all truth."""
    return relational.recall_precision(_overlap(spark, sf))


@query("""
WITH a AS (SELECT o_custkey AS k, count(*) AS v FROM orders WHERE o_orderstatus = 'F' GROUP BY 1), b AS (SELECT o_custkey AS k, count(*) AS v FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
SELECT coalesce(a.k, b.k) AS k, a.v AS expected, b.v AS found, CASE WHEN b.k IS NULL THEN 'missing' WHEN a.k IS NULL THEN 'unexpected' WHEN a.v = b.v THEN 'equal' ELSE 'differs' END AS state
FROM a FULL JOIN b ON a.k = b.k""")
def j18_full_outer_check(spark: SparkSession, sf: str) -> DataFrame:
    """Both-way coverage of two lists."""
    n = lambda s: table(spark, sf, "orders").filter(F.col("o_orderstatus") == s).groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("v"))
    return relational.compare_sides(n("F"), n("O"), ["k"], "v")


@query("""
WITH l AS (SELECT DISTINCT l_orderkey, l_suppkey FROM lineitem)
SELECT l_orderkey, s_name FROM l JOIN supplier ON l_suppkey = s_suppkey WHERE s_acctbal > 0""")
def j23_list_membership_join(spark: SparkSession, sf: str) -> DataFrame:
    """Rows joined by the members of a list each carries."""
    lists = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(F.collect_set("l_suppkey").alias("ids"))  # at most seven lines an order
    return relational.join_members(lists, table(spark, sf, "supplier").filter("s_acctbal > 0"), "ids", "s_suppkey").select("l_orderkey", "s_name")


@query("""
SELECT n_name AS nation, r_name AS region FROM nation CROSS JOIN region""")
def j31_cross_product(spark: SparkSession, sf: str) -> DataFrame:
    """A cross product of two small dimensions."""
    return table(spark, sf, "nation").select(F.col("n_name").alias("nation")).crossJoin(table(spark, sf, "region").select(F.col("r_name").alias("region")))


@query("""
WITH m AS (SELECT l_orderkey, max(CASE WHEN l_linenumber = 1 THEN l_partkey END) AS first, max(CASE WHEN l_linenumber = 2 THEN l_partkey END) AS second FROM lineitem WHERE l_linenumber <= 2 GROUP BY 1)
SELECT * FROM m WHERE first IS NOT NULL AND second IS NOT NULL""")
def j19_mates(spark: SparkSession, sf: str) -> DataFrame:
    """Two mates of a key side by side."""
    rows = table(spark, sf, "lineitem").filter("l_linenumber <= 2").groupBy("l_orderkey", F.col("l_linenumber").cast("string").alias("mate")).agg(F.max("l_partkey").alias("v"))
    return relational.paired(rows, "l_orderkey", "mate", "v")


@query("""
SELECT p_brand, list_transform(list_sort(list(struct_pack(k := p_partkey, v := p_name))), lambda x: x.v) AS members FROM part GROUP BY 1""")
def a01_group_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Groups as lists in input order."""
    return aggregates.first_seen_groups(table(spark, sf, "part"), "p_brand", "p_partkey", "p_name")


@query("""
SELECT user_id, arg_max(value, event_id) FILTER (event_type = 'click') AS click, arg_max(value, event_id) FILTER (event_type = 'error') AS error,
  arg_max(value, event_id) FILTER (event_type = 'purchase') AS purchase, arg_max(value, event_id) FILTER (event_type = 'signup') AS signup, arg_max(value, event_id) FILTER (event_type = 'view') AS view
FROM events GROUP BY 1""")
def a02_pivot_last_value(spark: SparkSession, sf: str) -> DataFrame:
    """Attribute rows pivoted, the last value of each counts."""
    return aggregates.pivot_last(table(spark, sf, "events"), "user_id", "event_type", "value", "event_id", ["click", "error", "purchase", "signup", "view"])


@query("""
SELECT l_returnflag, count(l_extendedprice) AS n, round(avg(l_extendedprice), 4) AS mean, round(stddev_samp(l_extendedprice), 4) AS sd, round(quantile_cont(l_extendedprice, 0.25), 4) AS q1,
  round(quantile_cont(l_extendedprice, 0.5), 4) AS median, round(quantile_cont(l_extendedprice, 0.75), 4) AS q3 FROM lineitem GROUP BY 1""")
def a03_numeric_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Mean, spread and interpolated quantiles."""
    return aggregates.describe_numbers(table(spark, sf, "lineitem"), ["l_returnflag"], "l_extendedprice", 4)


@query("""
WITH s AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY 1)
SELECT event_id, round((value - m) / coalesce(nullif(s, 0), 1), 4) AS z FROM events JOIN s USING (event_type)""")
def a07_z_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores against a group's mean and spread."""
    return aggregates.z_scores(table(spark, sf, "events"), "event_type", "value", 2).select("event_id", F.round("z", 4).alias("z"))


@query("""
WITH s AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY 1), z AS (SELECT user_id, event_type, (value - m) / coalesce(nullif(s, 0), 1) AS z FROM events JOIN s USING (event_type)),
 mods AS (SELECT * FROM (VALUES ('use', 'click'), ('use', 'view'), ('money', 'purchase'), ('money', 'signup')) t(module, event_type))
SELECT user_id, module, round(avg(z), 4) AS score FROM z JOIN mods USING (event_type) GROUP BY ALL""")
def a09_module_means(spark: SparkSession, sf: str) -> DataFrame:
    """Mean score of each module's members."""
    z = aggregates.z_scores(table(spark, sf, "events"), "event_type", "value", 2)
    mods = spark.createDataFrame([("use", "click"), ("use", "view"), ("money", "purchase"), ("money", "signup")], "module string, event_type string")
    return aggregates.module_means(z, mods, "event_type", "user_id").withColumn("score", F.round("score", 4))


@query("""
WITH s AS (SELECT event_type, avg(value) AS m, stddev_samp(value) AS s FROM events GROUP BY 1), z AS (SELECT user_id, event_type, (value - m) / coalesce(nullif(s, 0), 1) AS z FROM events JOIN s USING (event_type)),
 sig AS (SELECT * FROM (VALUES ('a', 'click', 1.0), ('a', 'error', -2.0), ('b', 'purchase', 0.5), ('b', 'view', 1.5)) t(signature, event_type, c)),
 p AS (SELECT user_id, signature, avg(CASE WHEN c > 0 THEN z * c END) AS u, avg(CASE WHEN c <= 0 THEN z * c END) AS d FROM z JOIN sig USING (event_type) GROUP BY ALL)
SELECT user_id, signature, round(CASE WHEN u IS NULL THEN d WHEN d IS NULL THEN u ELSE (u + d) / 2 END, 4) AS score FROM p""")
def a10_signature_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Signed signatures scored by the mean of two means (A10)."""
    z = aggregates.z_scores(table(spark, sf, "events"), "event_type", "value", 2)
    sig = spark.createDataFrame([("a", "click", 1.0), ("a", "error", -2.0), ("b", "purchase", 0.5), ("b", "view", 1.5)], "signature string, event_type string, coefficient double")
    return aggregates.signature_scores(z, sig, "event_type", "user_id").withColumn("score", F.round("score", 4))


@query("""
WITH h AS (SELECT range AS hour FROM range(24)), t AS (SELECT DISTINCT event_type FROM events), c AS (SELECT event_type, hour(ts) AS hour, count(*) AS n FROM events WHERE value > 400 GROUP BY ALL)
SELECT t.event_type, h.hour::BIGINT AS hour, coalesce(n, 0) AS n FROM t CROSS JOIN h LEFT JOIN c ON c.event_type = t.event_type AND c.hour = h.hour""")
def a31_zero_filled_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """Counts over all cells of a fixed matrix, zeros too."""
    e = table(spark, sf, "events")
    dims = e.select("event_type").distinct().crossJoin(spark.range(24).select(F.col("id").alias("hour")))
    counts = e.filter("value > 400").groupBy("event_type", F.hour("ts").cast("long").alias("hour")).agg(F.count("*").alias("n"))
    return aggregates.zero_filled(counts, dims, ["event_type", "hour"])


@query("""
SELECT coalesce(nullif(trim(o_orderstatus), 'P'), '(blank)') AS value, count(*) AS n FROM orders GROUP BY 1""")
def a58_count_values(spark: SparkSession, sf: str) -> DataFrame:
    """Counts by value, blanks named."""
    rows = table(spark, sf, "orders").withColumn("o_orderstatus", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).otherwise(" "))
    return aggregates.count_values(rows, "o_orderstatus")


@query("""
SELECT l_orderkey, coalesce(nullif(string_agg(DISTINCT CASE WHEN l_returnflag <> 'N' THEN l_returnflag END, ';' ORDER BY CASE WHEN l_returnflag <> 'N' THEN l_returnflag END), ''), 'none') AS flags FROM lineitem GROUP BY 1""")
def a48_joined_values(spark: SparkSession, sf: str) -> DataFrame:
    """Sorted distinct values in one text."""
    col = F.when(F.col("l_returnflag") != "N", F.col("l_returnflag"))
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(aggregates.joined_values(col).alias("flags"))


@query("""
SELECT n_name, arg_min(s_name, (-s_acctbal, s_suppkey)) AS s_name, max(s_acctbal) AS s_acctbal FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY 1""")
def a34_best_by(spark: SparkSession, sf: str) -> DataFrame:
    """A group's best row as an aggregate, without a window."""
    rows = table(spark, sf, "supplier").join(table(spark, sf, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    return aggregates.best_by(rows, "n_name", [-F.col("s_acctbal"), F.col("s_suppkey")], ["s_name", "s_acctbal"])


@query("""
WITH t AS (SELECT s_nationkey, sum(s_acctbal) AS t FROM supplier GROUP BY 1) SELECT s_suppkey, round(s_acctbal / greatest(t, 1e-9), 6) AS share FROM supplier JOIN t USING (s_nationkey)""")
def a22_share_of_total(spark: SparkSession, sf: str) -> DataFrame:
    """A row's share of its group."""
    return aggregates.share_of_total(table(spark, sf, "supplier"), ["s_nationkey"], "s_acctbal").select("s_suppkey", F.round("share", 6).alias("share"))


@query("""
WITH c AS (SELECT p_brand, p_type, max(p_retailprice) AS v FROM part GROUP BY ALL)
SELECT p_brand, list(p_type ORDER BY p, p_type) AS cols, list(v ORDER BY p, p_type) AS vals FROM (SELECT *, CASE p_type WHEN 'PROMO' THEN 1 WHEN 'ECONOMY' THEN 2 ELSE 3 END AS p FROM c) GROUP BY 1""")
def a41_sparse_matrix(spark: SparkSession, sf: str) -> DataFrame:
    """A sparse matrix with preferred columns first."""
    cells = aggregates.sparse_matrix(table(spark, sf, "part"), "p_brand", "p_type", "p_retailprice", ["PROMO", "ECONOMY"])
    return cells.select("p_brand", F.col("cells.k").alias("cols"), F.col("cells.v").alias("vals"))


@query("""
WITH d AS (SELECT strftime(o_orderdate, '%Y-%m-%d') AS day, sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END) AS finished, sum(CASE WHEN o_orderstatus <> 'F' THEN o_totalprice ELSE 0 END) AS other, sum(o_totalprice) AS total FROM orders GROUP BY 1)
SELECT count(*) AS days, round(sum(total), 0) AS total, round(sum(finished), 0) AS finished, round(sum(other), 0) AS other, round(avg(total), 0) AS daily_average, arg_min(day, (-total, day)) AS peak_day FROM d""")
def a42_daily_categories(spark: SparkSession, sf: str) -> DataFrame:
    """Daily sums by category, totals, average and peak day."""
    o = table(spark, sf, "orders").withColumn("day", F.date_format("o_orderdate", "yyyy-MM-dd"))
    is_f = F.col("o_orderstatus") == "F"
    days = o.groupBy("day").agg(F.sum(F.when(is_f, F.col("o_totalprice")).otherwise(0)).alias("finished"), F.sum(F.when(~is_f, F.col("o_totalprice")).otherwise(0)).alias("other"), F.sum("o_totalprice").alias("total"))
    r = lambda c: F.round(F.sum(c), 0).alias(c)
    return days.agg(F.count("*").alias("days"), r("total"), r("finished"), r("other"), F.round(F.avg("total"), 0).alias("daily_average"), F.min_by("day", F.struct(-F.col("total"), "day")).alias("peak_day"))


@query("""
WITH p AS (SELECT c_mktsegment || '/' || c_nationkey || '/' || c_custkey AS path, c_custkey AS size FROM customer),
x AS (SELECT '' AS prefix, size FROM p UNION ALL SELECT split_part(path, '/', 1), size FROM p UNION ALL SELECT split_part(path, '/', 1) || '/' || split_part(path, '/', 2), size FROM p)
SELECT prefix, count(*) AS files, sum(size)::BIGINT AS bytes, max(size) AS latest FROM x GROUP BY 1""")
def a43_prefix_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Size, count and latest of every folder on each path."""
    c = table(spark, sf, "customer").select(F.concat_ws("/", "c_mktsegment", F.col("c_nationkey").cast("string"), F.col("c_custkey").cast("string")).alias("path"), "c_custkey")
    return aggregates.prefix_rollup(c, "path", "c_custkey", "c_custkey")


@query("""
SELECT count(*) AS positions, round(avg(l_quantity), 4) AS tumor_mean, round(avg(l_linenumber), 4) AS normal_mean, count(*) FILTER (l_quantity >= 3 AND l_linenumber >= 3) AS covered,
  round(avg(CASE WHEN l_quantity >= 3 AND l_linenumber >= 3 THEN 1.0 ELSE 0.0 END), 4) AS covered_share FROM lineitem""")
def a16_depth_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Counts, means and share of rows deep enough in both columns, in one pass."""
    from ..operators.genomics import depth_summary

    return depth_summary(table(spark, sf, "lineitem"), "l_quantity", "l_linenumber", 3)


@query("""
WITH r AS (SELECT o_orderkey, o_orderpriority, o_totalprice, row_number() OVER (PARTITION BY o_orderpriority ORDER BY o_totalprice DESC, o_orderkey) AS rank FROM orders)
SELECT * FROM r WHERE rank <= CASE o_orderpriority WHEN '1-URGENT' THEN 8 WHEN '2-HIGH' THEN 4 ELSE 2 END""")
def w03_top_per_category(spark: SparkSession, sf: str) -> DataFrame:
    """The first k of each category, k by category."""
    k = F.when(F.col("o_orderpriority") == "1-URGENT", 8).when(F.col("o_orderpriority") == "2-HIGH", 4).otherwise(2)
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", "o_totalprice")
    top = windows.top_per_group(rows, ["o_orderpriority"], [F.col("o_totalprice").desc(), F.col("o_orderkey")], 8, "rank")  # the largest k, so that tasks cut early
    return top.filter(F.col("rank") <= k)


@query("""
SELECT c_custkey, CASE WHEN greatest(a, b, c) = a THEN 'balance' WHEN greatest(b, c) = b THEN 'nation' ELSE 'key' END AS best, CASE WHEN b >= c THEN 'nation' ELSE 'key' END AS refined
FROM (SELECT c_custkey, c_acctbal / 1000 AS a, c_nationkey::DOUBLE AS b, (c_custkey % 10)::DOUBLE AS c FROM customer)""")
def w05_argmax_fixed_order(spark: SparkSession, sf: str) -> DataFrame:
    """The best of several scores with a fixed order on ties, and again without some."""
    s = {"balance": F.col("c_acctbal") / 1000, "nation": F.col("c_nationkey").cast("double"), "key": (F.col("c_custkey") % 10).cast("double")}
    return table(spark, sf, "customer").select("c_custkey", windows.argmax_by_order(s).alias("best"), windows.argmax_by_order(s, ("balance",)).alias("refined"))


@query("""
WITH n AS (SELECT l_orderkey, l_linenumber, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) AS ordinal FROM lineitem)
SELECT l_orderkey, l_linenumber, ordinal FROM n WHERE (ordinal - 1) % 50 = 0""")
def w08_stride_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Every fiftieth row of a total order, numbered without one large task."""
    rows = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    order = [F.col(c) for c in ("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")]
    return relational.in_order(rows, order, F.floor(F.col("l_orderkey") / 1000)).filter("(ordinal - 1) % 50 = 0").select("l_orderkey", "l_linenumber", F.col("ordinal").cast("long").alias("ordinal"))


@query("""
WITH t AS (SELECT s_suppkey AS idx, (SELECT count(*) FROM lineitem) AS total, (SELECT count(*) FROM supplier) AS k FROM supplier)
SELECT idx, (total // k * idx + least(idx, total % k))::BIGINT AS first, (total // k + CASE WHEN idx < total % k THEN 1 ELSE 0 END)::BIGINT AS n FROM t""")
def w18_balanced_shards(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges of balanced shards."""
    totals = table(spark, sf, "lineitem").agg(F.count("*").alias("total")).crossJoin(table(spark, sf, "supplier").agg(F.count("*").alias("k")))  # one row
    rows = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("idx")).crossJoin(F.broadcast(totals))
    base, rest = F.floor(F.col("total") / F.col("k")), F.col("total") % F.col("k")
    return rows.select("idx", (base * F.col("idx") + F.least("idx", rest)).cast("long").alias("first"), (base + F.when(F.col("idx") < rest, 1).otherwise(0)).cast("long").alias("n"))


@query("""
WITH RECURSIVE e AS (SELECT c_custkey AS c, c_custkey // 2 AS p FROM customer WHERE c_custkey > 0), up(node, ancestor, depth) AS (SELECT c, p, 1 FROM e UNION ALL SELECT u.node, e.p, u.depth + 1 FROM up u JOIN e ON u.ancestor = e.c)
SELECT node, ancestor, depth::BIGINT AS depth FROM up""")
def w20_tree_closure(spark: SparkSession, sf: str) -> DataFrame:
    """All ancestors of each node of a tree."""
    edges = table(spark, sf, "customer").filter("c_custkey > 0").select(F.col("c_custkey").alias("c"), F.expr("c_custkey DIV 2").alias("p"))
    return windows.closure(edges, "c", "p").withColumn("depth", F.col("depth").cast("long"))


@query("""
WITH a AS (SELECT s_suppkey, s_name, row_number() OVER (PARTITION BY s_nationkey ORDER BY s_acctbal, s_suppkey) AS r FROM supplier), best AS (SELECT s_suppkey, s_name FROM a WHERE r = 1)
SELECT s_suppkey, s_name, 'anchor' AS kind FROM best UNION ALL SELECT s_suppkey, s_name, 'seed' FROM supplier WHERE s_suppkey % 7 = 0 AND s_suppkey NOT IN (SELECT s_suppkey FROM best)""")
def w21_anchors_and_seeds(spark: SparkSession, sf: str) -> DataFrame:
    """Each group's best row, then seeds that aren't among them."""
    s = table(spark, sf, "supplier")
    best = windows.best_per_group(s, ["s_nationkey"], [F.col("s_acctbal").asc_nulls_last(), F.col("s_suppkey")]).select("s_suppkey", "s_name")
    seeds = s.filter("s_suppkey % 7 = 0").select("s_suppkey", "s_name").join(best, "s_suppkey", "left_anti")
    return best.withColumn("kind", F.lit("anchor")).unionByName(seeds.withColumn("kind", F.lit("seed")))


@query("SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100")
def o01_top_k(spark: SparkSession, sf: str) -> DataFrame:
    """The first hundred of a total order."""
    return table(spark, sf, "orders").select("o_orderkey", "o_totalprice").orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(100)


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events WHERE (ts, event_id) < (TIMESTAMP '2024-01-20 00:00:00', 0) ORDER BY ts DESC, event_id DESC LIMIT 50""")
def o09_keyset_page(spark: SparkSession, sf: str) -> DataFrame:
    """A page before a cursor."""
    e = table(spark, sf, "events")
    at = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    rows = e.filter((F.col("ts") < at) | ((F.col("ts") == at) & (F.col("event_id") < 0)))
    return rows.orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(50).select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("at"))


@query("""
SELECT c_nationkey AS key FROM customer INTERSECT SELECT s_nationkey FROM supplier""")
def u03_intersection(spark: SparkSession, sf: str) -> DataFrame:
    """Set intersection."""
    return table(spark, sf, "customer").select(F.col("c_nationkey").alias("key")).intersect(table(spark, sf, "supplier").select("s_nationkey"))


@query("SELECT c_custkey AS key FROM customer EXCEPT SELECT o_custkey FROM orders")
def u04_difference(spark: SparkSession, sf: str) -> DataFrame:
    """Set difference by an anti join."""
    c, o = table(spark, sf, "customer").select(F.col("c_custkey").alias("key")), table(spark, sf, "orders").select(F.col("o_custkey").alias("key"))
    return c.distinct().join(o, "key", "left_anti")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def u08_duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Keys that occur more than once."""
    return relational.duplicates(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("""
WITH u AS (SELECT c_custkey AS k, c_name AS v, 0 AS p FROM customer UNION ALL SELECT s_suppkey, s_name, 1 FROM supplier) SELECT k, arg_max(v, p) AS v FROM u GROUP BY 1""")
def u10_merge_by_priority(spark: SparkSession, sf: str) -> DataFrame:
    """A union in which the later table wins."""
    a = table(spark, sf, "customer").select(F.col("c_custkey").alias("k"), F.col("c_name").alias("v"))
    return relational.merged_by_priority([a, table(spark, sf, "supplier").select(F.col("s_suppkey").alias("k"), F.col("s_name").alias("v"))], ["k"])


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_quantity + l_tax > 0 THEN round(l_quantity / (l_quantity + l_tax), 6) END AS share, round(log2(l_quantity + 1), 4) AS log_quantity,
  round(log2((l_quantity + 0.0001) / (l_linenumber + 0.0001)), 4) AS log_ratio, greatest(0, least(1, l_quantity / 40)) AS clamped FROM lineitem""")
def m01_number_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Ratios, logarithms and clamps."""
    ratio = numeric.log2_ratio("l_quantity", F.col("l_linenumber"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        F.round(numeric.allele_fraction("l_quantity", "l_tax"), 6).alias("share"),
        F.round(numeric.log2_plus_one("l_quantity"), 4).alias("log_quantity"),
        F.round(ratio, 4).alias("log_ratio"),
        numeric.clamped(F.col("l_quantity") / 40).alias("clamped"),
    )


@query("""
WITH l AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_discount >= 0.08 THEN 'likely_damaging' WHEN l_discount >= 0.03 THEN 'missense_or_vus' END AS cls, CASE WHEN l_linenumber <= 3 THEN 'BRCA1' ELSE 'PALB2' END AS gene,
   CASE WHEN l_quantity < 20 THEN -1 WHEN l_quantity < 30 THEN 0 END AS cna, CASE WHEN l_tax = 0 THEN 'expected_hrd_negative' ELSE 'expected_hrd_like' END AS label, l_tax * 6 AS fga, l_linenumber * 2.0 AS an FROM lineitem),
s AS (SELECT *, CASE WHEN fga >= 0.35 OR an >= 12 THEN 'copy_number_scar_proxy_high' WHEN fga >= 0.2 OR an >= 6 THEN 'copy_number_scar_proxy_intermediate' ELSE 'copy_number_scar_proxy_low' END AS scar FROM l),
p AS (SELECT *, CASE WHEN cls = 'likely_damaging' AND gene = 'BRCA1' AND coalesce(cna <= -1, false) AND scar LIKE '%high' THEN 'strong_hrd_like_candidate'
   WHEN cls = 'likely_damaging' AND coalesce(cna <= -1, false) AND (scar LIKE '%high' OR scar LIKE '%intermediate') THEN 'suggestive_hrd_like_candidate'
   WHEN cls IS NULL AND label = 'expected_hrd_negative' AND scar LIKE '%low' THEN 'low_evidence_negative_candidate' WHEN cls IS NOT NULL THEN 'ambiguous_or_incomplete' ELSE 'not_assessable' END AS pred FROM s)
SELECT CASE WHEN label LIKE '%negative%' THEN 'expected_negative' ELSE 'expected_hrd_like' END AS expected, pred,
 CASE WHEN pred LIKE '%hrd_like%' THEN 'predicted_hrd_like' WHEN pred LIKE '%negative%' THEN 'predicted_negative' ELSE 'predicted_ambiguous_or_not_assessable' END AS bucket, count(*) AS n FROM p GROUP BY ALL""")
def p26_rule_ladders(spark: SparkSession, sf: str) -> DataFrame:
    """Ordered rules with explicit no-calls, counted by expected and predicted bucket."""
    li = table(spark, sf, "lineitem").select(
        F.when(F.col("l_discount") >= 0.08, "likely_damaging").when(F.col("l_discount") >= 0.03, "missense_or_vus").alias("cls"),
        F.when(F.col("l_linenumber") <= 3, "BRCA1").otherwise("PALB2").alias("gene"),
        F.when(F.col("l_quantity") < 20, -1).when(F.col("l_quantity") < 30, 0).alias("cna"),
        F.when(F.col("l_tax") == 0, "expected_hrd_negative").otherwise("expected_hrd_like").alias("label"),
        (F.col("l_tax") * 6).alias("fga"),
        (F.col("l_linenumber") * 2.0).alias("an"),
    )
    li = li.withColumn("scar", rules.scar_class("fga", "an"))
    li = li.withColumn("pred", rules.prediction("cls", "gene", "cna", "label", "scar"))
    return li.groupBy(rules.expected_bucket("label").alias("expected"), "pred", rules.prediction_bucket("pred").alias("bucket")).agg(F.count("*").alias("n"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_linenumber <= -2 THEN '' WHEN l_linenumber - 3 <= -2 THEN 'deep_deletion' WHEN l_linenumber - 3 = -1 THEN 'shallow_loss' WHEN l_linenumber - 3 = 0 THEN 'neutral' WHEN l_linenumber - 3 = 1 THEN 'gain' ELSE 'amplification' END AS state,
 CASE WHEN l_discount * 10 >= 0.75 THEN 'High' WHEN l_discount * 10 >= 0.55 THEN 'Medium' WHEN l_discount * 10 >= 0.35 THEN 'Low' ELSE 'VeryLow' END AS confidence,
 (l_linenumber & 1) = 1 AND (l_linenumber & 6) = 0 AS discordant FROM lineitem""")
def p24_state_ladders(spark: SparkSession, sf: str) -> DataFrame:
    """Copy states, confidence labels and flag predicates."""
    return table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", rules.copy_state(F.col("l_linenumber") - 3).alias("state"), rules.confidence(F.col("l_discount") * 10).alias("confidence"), rules.discordant("l_linenumber").alias("discordant"))


@query("""
SELECT p_partkey, trim(regexp_replace(lower(p_type || ' ' || p_brand), '[^a-z0-9]+', '_', 'g'), '_') AS slug, trim(regexp_replace(lower(p_brand), '[^a-z0-9]+', ' ', 'g')) AS words,
  reverse(translate(regexp_replace(upper(p_name), '[^ACGT]', 'N', 'g'), 'ACGT', 'TGCA')) AS reverse_complement, sha256(p_name || chr(0) || p_type) AS event_key FROM part""")
def f01_name_functions(spark: SparkSession, sf: str) -> DataFrame:
    """Slugs, plain words, reverse complements and content keys."""
    p = table(spark, sf, "part")
    return p.select("p_partkey", text.slug(F.concat_ws(" ", "p_type", "p_brand")).alias("slug"), text.words_only("p_brand").alias("words"), text.reverse_complement("p_name").alias("reverse_complement"), text.event_key("p_name", "p_type").alias("event_key"))
