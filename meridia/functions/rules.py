"""Rule ladders over Columns: ordered cases, with what can't be told left as an explicit state."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import ColumnLike, _c, slug

# The names that data and results use.
DAMAGING = ("Nonsense_Mutation", "Frame_Shift_Del", "Frame_Shift_Ins", "Splice_Site", "Translation_Start_Site", "Nonstop_Mutation")
BRCA = ("BRCA1", "BRCA2")
LOSSES = ("focal_loss", "deep_deletion", "homozygous_deletion", "loss")
DISRUPTIONS = ("disruptive", "frameshift", "frame_shift", "nonsense", "splice", "loss_of_function", "target_loss")
GAINS = ("copy_gain", "gain", "amplification", "high_amplification")
CALLABLE = ("callable", "ready", "passed", "pass", "covered")


def mutation_class(kind: ColumnLike, keyword: ColumnLike) -> Column:
    """likely_damaging, missense_or_vus or other."""
    return (
        F.when(_c(kind).isin(*DAMAGING) | F.coalesce(_c(keyword).rlike("(?i)truncating|frameshift|splice"), F.lit(False)), "likely_damaging")
        .when(_c(kind).rlike("(?i)missense"), "missense_or_vus")
        .otherwise("other")
    )


def mutation_score(cls: ColumnLike) -> Column:
    """3, 1 or 0."""
    return F.when(_c(cls) == "likely_damaging", 3).when(_c(cls) == "missense_or_vus", 1).otherwise(0)


def copy_state(x: ColumnLike) -> Column:
    """A discrete copy number's state; values between the steps show as they are."""
    v = _c(x)
    return (
        F.when(v.isNull(), "not_available").when(v <= -2, "deep_deletion").when(v == -1, "shallow_loss").when(v == 0, "neutral").when(v == 1, "gain").when(v >= 2, "amplification").otherwise(v.cast("string"))
    )


def scar_class(altered: ColumnLike, aneuploidy: ColumnLike) -> Column:
    """How much of a copy-number scar two figures show; either may be missing."""
    f, a = F.coalesce(_c(altered), F.lit(0.0)), F.coalesce(_c(aneuploidy), F.lit(0.0))
    name = "copy_number_scar_proxy_"
    return (
        F.when((f >= 0.35) | (a >= 12), name + "high").when((f >= 0.2) | (a >= 6), name + "intermediate").when(_c(altered).isNotNull() | _c(aneuploidy).isNotNull(), name + "low").otherwise("not_assessable")
    )


def prediction(cls: ColumnLike, gene: ColumnLike, copies: ColumnLike, expected: ColumnLike, scar: ColumnLike) -> Column:
    """The candidate class of a sample's best mutation (class null if it has none), second hit and scar."""
    has, damaging = _c(cls).isNotNull(), F.coalesce(_c(cls) == "likely_damaging", F.lit(False))
    second = F.coalesce(_c(copies) <= -1, F.lit(False))
    high, mid, low = (_c(scar) == f"copy_number_scar_proxy_{k}" for k in ("high", "intermediate", "low"))
    return (
        F.when(damaging & _c(gene).isin(*BRCA) & second & high, "strong_hrd_like_candidate")
        .when(damaging & second & (high | mid), "suggestive_hrd_like_candidate")
        .when(~has & (_c(expected) == "expected_hrd_negative") & low, "low_evidence_negative_candidate")
        .when(has, "ambiguous_or_incomplete")
        .otherwise("not_assessable")
    )


def prediction_bucket(x: ColumnLike) -> Column:
    """Three buckets of predictions."""
    return F.when(_c(x).contains("hrd_like"), "predicted_hrd_like").when(_c(x).contains("negative"), "predicted_negative").otherwise("predicted_ambiguous_or_not_assessable")


def expected_bucket(x: ColumnLike) -> Column:
    """Four buckets of expected labels; their order matters."""
    v = _c(x)
    return F.when(v.contains("negative"), "expected_negative").when(v.contains("ambiguous"), "expected_ambiguous").when(v.contains("hrd") | v.contains("positive"), "expected_hrd_like").otherwise("expected_unknown")


def second_hit(cls: ColumnLike, copies: ColumnLike) -> Column:
    """Whether copy loss supports a second hit."""
    lost = F.coalesce(_c(copies) <= -1, F.lit(False))
    return F.when(_c(cls).isNull(), "no_causal_event_to_assess").when((_c(cls) == "likely_damaging") & lost, "copy_loss_proxy_supports_second_hit").otherwise("second_hit_not_proven")


def panel_category(damaging_brca: ColumnLike, damaging_other: ColumnLike, any_hit: ColumnLike, copies: ColumnLike, brca1: ColumnLike, brca2: ColumnLike, altered: ColumnLike, mutations: ColumnLike) -> Column:
    """The control that a sample can serve as."""
    lost = F.coalesce(_c(copies) <= -1, F.lit(False))
    zero = lambda x: F.coalesce(_c(x), F.lit(0)) == 0
    quiet = ~_c(any_hit) & zero(brca1) & zero(brca2) & (_c(altered) <= 0.15) & (F.coalesce(_c(mutations), F.lit(0)) <= 80)
    return (
        F.when(_c(damaging_brca) & lost & (_c(altered) >= 0.3), "positive_control")
        .when(_c(damaging_other) & lost & (_c(altered) >= 0.25), "mechanistic_control")
        .when(_c(any_hit), "ambiguous_control")
        .when(quiet, "negative_control")
        .otherwise("background")
    )


def panel_score(category: ColumnLike, altered: ColumnLike, event: ColumnLike) -> Column:
    """By which a category's samples are ranked."""
    f, e = _c(altered).cast("double"), _c(event).cast("double")
    return (
        F.when(_c(category) == "positive_control", f * 100 + e + 1000)
        .when(_c(category) == "mechanistic_control", f * 100 + e + 800)
        .when(_c(category) == "ambiguous_control", f + e + 500)
        .when(_c(category) == "negative_control", F.lit(300.0) - f * 100)
        .otherwise(0.0)
    )


def rna_context(basal: ColumnLike, luminal: ColumnLike, immune: ColumnLike, subtype: ColumnLike, call: ColumnLike) -> Column:
    """The expression context by module scores (missing: 0) and two labels."""
    b, a, i = (F.coalesce(_c(x), F.lit(0.0)) for x in (basal, luminal, immune))
    named = F.lower(F.coalesce(_c(subtype), F.lit(""))).contains("basal") | F.lower(F.coalesce(_c(call), F.lit(""))).contains("basal")
    return F.when(named | (b >= 0.75), "basal_like_context").when((a >= 0.75) & (b < 0.5), "lar_luminal_marker_context").when(i >= 0.75, "immune_inflamed_context").otherwise("mixed_or_non_basal_context")


def coverage_class(x: ColumnLike) -> Column:
    """Gain or loss of coverage by a log2 ratio."""
    return F.when(_c(x) >= 0.5, "relative_gain").when(_c(x) <= -0.5, "relative_loss").otherwise("neutral_or_low_signal")


def receptor_status(*receptors: ColumnLike) -> Column:
    """Triple-negative or not, by receptor fields."""
    every = F.array(*[F.lower(F.trim(F.coalesce(_c(x), F.lit("")))) for x in receptors])
    negative = lambda v: v == "negative"
    return (
        F.when(F.forall(every, negative), "xena_triple_negative")
        .when(F.exists(every, lambda v: v.isin("positive", "equivocal")), "not_tnbc_from_xena_receptor_fields")
        .when(F.exists(every, negative), "incomplete_receptor_fields")
        .otherwise("no_receptor_fields_in_subset")
    )


def subtype_evidence(has_call: ColumnLike, receptor: ColumnLike, subtype: ColumnLike, call: ColumnLike) -> Column:
    """Where a subtype's evidence stands."""
    return (
        F.when(_c(has_call), "confirmed_from_lehmann_tcga_s1")
        .when(_c(receptor) == "not_tnbc_from_xena_receptor_fields", "not_applicable_not_tnbc_from_available_fields")
        .when(_c(receptor) == "xena_triple_negative", "needs_classifier_run_not_in_official_s1")
        .when(_c(subtype).contains("Basal") | (_c(call) == "Basal"), "basal_context_but_not_official_lehmann_tnbc")
        .otherwise("no_call_not_in_official_lehmann_tcga_tnbc")
    )


def rna_evidence(status: ColumnLike) -> Column:
    """Evidence by an RNA status."""
    s = slug(status)
    return F.when(s.isin("detected", "expressed", "present", "partial_evidence", "supported"), "partial_evidence").when(s.isin("not_detected", "not_supported"), "not_supported").otherwise("no_call")


def target_state(has_evidence: ColumnLike, family: ColumnLike, copies: ColumnLike, effect: ColumnLike, hla: ColumnLike, callability: ColumnLike, rna: ColumnLike) -> Column:
    """struct(overall_status, candidate_class, dna_status) of a target candidate. Loss and disruption come first."""
    c, v, h, k = slug(copies), slug(effect), slug(hla), slug(callability)
    lost = c.isin(*LOSSES) | v.isin(*DISRUPTIONS) | h.isin("loss", "hla_loss", "loh")
    gain, ready = c.isin(*GAINS), k.isin(*CALLABLE)

    def state(overall: str, cls: str, dna: Column | str) -> Column:
        return F.struct(F.lit(overall).alias("overall_status"), F.lit(cls).alias("candidate_class"), (F.lit(dna) if isinstance(dna, str) else dna).alias("dna_status"))

    seen = F.when(ready | gain, "partial_evidence").otherwise("no_call")
    return (
        F.when(~_c(has_evidence), state("blocked", "blocked", "no_call"))
        .when(lost, state("not_supported", "not_supported_candidate", "not_supported"))
        .when((_c(family) == "ddr_transcription_cdk") & (gain | ready), state("partial_evidence", "ddr_transcriptional_cdk_followup", "partial_evidence"))
        .when(_c(family) == "cell_cycle_resistance", state("partial_evidence", "cell_cycle_resistance_context", seen))
        .when((_c(rna) == "partial_evidence") & (gain | ready), state("partial_evidence", "surface_target_followup", "partial_evidence"))
        .when(gain | ready, state("no_call", "dna_only_followup", "partial_evidence"))
        .otherwise(state("no_call", "no_call", "no_call"))
    )


def coding_component(coding: ColumnLike, clinvar: ColumnLike) -> Column:
    """1, 0.6, 0.3 or 0 by coding and clinical support."""
    return F.when((_c(coding) == "coding") & (_c(clinvar) == "present"), 1.0).when(_c(coding) == "coding", 0.6).when(_c(coding) == "noncoding", 0.3).otherwise(0.0)


def confidence(x: ColumnLike) -> Column:
    """High, Medium, Low or VeryLow."""
    return F.when(_c(x) >= 0.75, "High").when(_c(x) >= 0.55, "Medium").when(_c(x) >= 0.35, "Low").otherwise("VeryLow")


def copy_direction(ratio: ColumnLike, expected: ColumnLike) -> Column:
    """Whether a depth ratio goes the expected way."""
    return F.when(_c(expected) == "loss", _c(ratio) < 0.85).when(_c(expected) == "gain", _c(ratio) > 1.05).otherwise(False)


def somatic_like(tumor_depth: ColumnLike, normal_depth: ColumnLike, tumor_share: ColumnLike, normal_share: ColumnLike, least: int = 10) -> Column:
    """Deep enough, ALT in the tumor and hardly any in the normal."""
    return F.coalesce((_c(tumor_depth) >= least) & (_c(normal_depth) >= least) & (_c(tumor_share) >= 0.2) & (_c(normal_share) <= 0.05), F.lit(False))


def plain_snv(ref: ColumnLike, alt: ColumnLike) -> Column:
    """Single bases on both sides."""
    return (F.length(_c(ref)) == 1) & (F.length(_c(alt)) == 1)


def supplementary(flag: ColumnLike) -> Column:
    """An alignment's flag 2048."""
    return _c(flag).bitwiseAND(2048) != 0


def discordant(flag: ColumnLike) -> Column:
    """Paired, and neither properly so nor with an unmapped end."""
    return (_c(flag).bitwiseAND(1) == 1) & (_c(flag).bitwiseAND(14) == 0)
