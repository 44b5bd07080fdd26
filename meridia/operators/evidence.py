"""Evidence synthesis: agreement of reviewers, states and roll-ups with explicit no-calls."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import burden_support, locus_score
from ..functions.rules import coding_component, confidence
from .aggregates import joined_values, single_or


def agreement(claims: DataFrame, subject: str, reviewer: str, state: str, reviewers: int = 2) -> DataFrame:
    """(subject, states, n_reviewers, agreement): what reviewers say of a subject, in one aggregation."""
    n, distinct = F.count_distinct(reviewer), F.count_distinct(state)
    status = F.when(n < reviewers, "single_reviewer").when(distinct == 1, "agree").otherwise("disagree")
    return claims.groupBy(subject).agg(joined_values(F.col(state)).alias("states"), n.alias("n_reviewers"), status.alias("agreement"))


def aggregate_state(evidence: DataFrame, subject: str, state: str) -> DataFrame:
    """(subject, state): the one state all evidence has, else partial_evidence."""
    return evidence.groupBy(subject).agg(single_or(F.col(state), "partial_evidence").alias("state"))


def authorised_state(evidence: DataFrame, subject: str, state: str, unclassified: str = "no_call") -> DataFrame:
    """(subject, state): the one classified state, no_call if none; two of them fail the query."""
    seen = F.collect_set(F.when(F.col(state) != unclassified, F.col(state)))
    out = evidence.groupBy(subject).agg(seen.alias("_s"))
    bad = F.raise_error(F.concat(F.lit("conflicting states for "), F.col(subject).cast("string"))).cast("string")
    return out.select(subject, F.when(F.size("_s") > 1, bad).otherwise(F.coalesce(F.get("_s", F.lit(0)), F.lit(unclassified))).alias("state"))


def members_of_lists(claims: DataFrame, evidence: DataFrame, list_col: str, id_col: str) -> DataFrame:
    """Claims with each piece of evidence in their semicolon list."""
    from ..functions.text import listed
    from .relational import join_members

    return join_members(claims.withColumn("_ids", listed(list_col)), evidence, "_ids", id_col).drop("_ids")


def evidence_rows(summaries: DataFrame, subject: str, payload: str, builders: dict[str, list[tuple[str, str, str, str, str]]], kind: str) -> DataFrame:
    """(subject, evidence_id, status, detail, artifact, caveat): what the builders of a summary's kind make of its JSON text.

    A builder is (id, path of the status, path of the detail, artifact, caveat); a summary without the status says no_call, one without the
    detail has none. All builders stand in one array, so the summaries are read once."""
    from ..functions.json import at_path

    made = [
        F.when(
            F.col(kind) == k,
            F.struct(F.lit(own).alias("evidence_id"), F.coalesce(at_path(payload, status), F.lit("no_call")).alias("status"), F.coalesce(at_path(payload, detail), F.lit("")).alias("detail"), F.lit(artifact).alias("artifact"), F.lit(caveat).alias("caveat")),
        )
        for k, items in builders.items()
        for own, status, detail, artifact, caveat in items
    ]
    return summaries.select(subject, F.explode(F.array_compact(F.array(*made))).alias("_e")).select(subject, "_e.*")


def packet_rows(evidence: list[DataFrame], keys: list[str], forbidden: list[str], text_cols: list[str]) -> DataFrame:
    """The union of evidence of one schema, a later table's row for an earlier one's of the same keys; a text with a forbidden word fails the query."""
    from ..functions.text import any_token_in
    from .relational import merged_by_priority

    rows = merged_by_priority(evidence, keys)
    for c in text_cols:
        bad = F.raise_error(F.concat(F.lit(f"forbidden word in {c} of "), F.concat_ws(":", *[F.col(k).cast("string") for k in keys]))).cast("string")
        rows = rows.withColumn(c, F.when(any_token_in(c, forbidden), bad).otherwise(F.col(c)))
    return rows


def readiness(dependencies: DataFrame, unit: str, ready: str, blockers: str) -> DataFrame:
    """(unit, ready, any_ready, blockers): all, any, and the sum over what a unit depends on."""
    return dependencies.groupBy(unit).agg(F.every(ready).alias("ready"), F.some(ready).alias("any_ready"), F.sum(blockers).alias("blockers"))


def status_rollup(df: DataFrame, status: Column) -> DataFrame:
    """One row: total, confirmed, partial, blocked, no_call, other."""
    names = ("confirmed", "partial", "blocked", "no_call")
    counts = [F.count_if(status.startswith(n)).alias(n) for n in names]
    other = F.count_if(~F.coalesce(status.rlike("^(" + "|".join(names) + ")"), F.lit(False)))
    return df.agg(F.count("*").alias("total"), *counts, other.alias("other"))


def locus_gene_scores(evidence: DataFrame) -> DataFrame:
    """(locus, symbol, components, overall, confidence) of evidence rows (locus, symbol, l2g, h4, clpp, tissue, burden_p, coding, clinvar).

    Locus-to-gene and colocalisation count by their largest, tissues by a third each up to one, the burden by its least p.
    """
    coloc = F.max(F.coalesce("h4", "clpp", F.lit(0.0)))
    tissues = F.count_distinct(F.when((F.trim("tissue") != "") & (F.col("tissue") != "."), F.col("tissue")))
    out = evidence.groupBy("locus", "symbol").agg(
        F.coalesce(F.max("l2g"), F.lit(0.0)).alias("l2g"),
        F.coalesce(coloc, F.lit(0.0)).alias("coloc"),
        F.least(F.lit(1.0), tissues / 3.0).alias("eqtl"),
        burden_support(F.min("burden_p"))["component"].alias("burden"),
        coding_component(F.when(F.some("coding"), "coding").when(F.some("clinvar"), "noncoding").otherwise("none"), F.when(F.some("clinvar"), "present").otherwise("none")).alias("coding"),
    )
    out = out.withColumn("overall", F.round(locus_score("l2g", "coloc", "eqtl", "burden", "coding"), 6))
    return out.withColumn("confidence", confidence("overall"))


def across_loci(scores: DataFrame) -> DataFrame:
    """(symbol, supporting_loci, mean_score, max_score)."""
    return scores.groupBy("symbol").agg(F.count("*").alias("supporting_loci"), F.round(F.avg("overall"), 8).alias("mean_score"), F.round(F.max("overall"), 6).alias("max_score"))


def best_studies(scored: DataFrame, most: int) -> DataFrame:
    """(study, score, terms) of (study, term, score, has_statistics): the largest score of a study and the terms it matched, in order;
    studies with statistics first, `most` of them."""
    out = scored.groupBy("study").agg(F.max("score").alias("score"), F.array_join(F.array_sort(F.collect_set("term")), ";").alias("terms"), F.some("has_statistics").alias("s"))
    return out.orderBy(F.desc("s"), F.desc("score"), "study").limit(most).drop("s")
