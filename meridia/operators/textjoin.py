"""Joins of texts with terms by their words, without comparing all pairs: an inverted index of words, probed with each term's rarest ones.

Words are lower-case runs of letters and digits. A term that a text contains as a string has its inner words as words of the text, its
first one as the end and its last one as the beginning of one; so only the vocabulary, which grows far slower than the texts, is
searched for parts of words, through an index of grams of three signs. Each found pair is checked on the whole texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text
from ..sources.tables import checkpointed

#: Texts of up to so many words are kept apart by their number of words, since few words may do to score against them.
SHORT = 16
GRAM = 3


def _numbered(df: DataFrame, name: str) -> DataFrame:
    return checkpointed(df.withColumn(name, F.monotonically_increasing_id()))


def _plain_words(x: str) -> Column:
    """The distinct words of a text in words only."""
    return F.array_distinct(F.filter(F.split(text.words_only(x), " "), lambda w: w != ""))


def _grams(word: str) -> Column:
    """The grams of a word, of all lengths up to GRAM."""
    n = F.length(word)
    return F.array_distinct(F.flatten(F.transform(F.sequence(F.lit(1), F.least(F.lit(GRAM), n)), lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substr(F.col(word), i, k)))))


def words_with(vocabulary: DataFrame, parts: DataFrame) -> DataFrame:
    """(part, how, word, df) for parts (part, how): the words (word, df) that are the part, end or begin with it, or hold it, as `how` says."""
    parts = parts.distinct()
    same = parts.filter("how = 'is'").join(vocabulary, F.col("part") == F.col("word"))
    some = parts.filter("how <> 'is'")
    index = vocabulary.select("word", "df", F.explode(_grams("word")).alias("gram"))
    wanted = some.select("part", "how", F.explode(F.filter(_grams("part"), lambda g: F.length(g) == F.least(F.lit(GRAM), F.length("part")))).alias("gram"))
    # Of a part's longest grams the one that the fewest words have.
    rare = index.join(wanted.select("gram").distinct(), "gram", "left_semi").groupBy("gram").agg(F.count("*").alias("n"))
    probe = wanted.join(rare, "gram").groupBy("part", "how").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    fits = F.when(F.col("how") == "ends", F.endswith("word", "part")).when(F.col("how") == "begins", F.startswith("word", "part")).otherwise(F.contains("word", "part"))
    found = probe.join(index, "gram").filter(fits)
    return same.select("part", "how", "word", "df").unionByName(found.select("part", "how", "word", "df"))


def _probed(docs: DataFrame, probes: DataFrame) -> DataFrame:
    """Pairs (_l, _r) of docs (_l, words) and probes (_r, part, how), of which a row's rarest one counts; a row all of whose parts are in no word has none."""
    index = docs.select("_l", F.explode("words").alias("word"))
    vocabulary = checkpointed(index.groupBy("word").agg(F.count("*").alias("df")))
    found = checkpointed(words_with(vocabulary, probes.select("part", "how")))
    rows = found.groupBy("part", "how").agg(F.sum("df").alias("n"))
    # A part that no word has rules its row out, so it is the rarest.
    best = probes.join(rows, ["part", "how"], "left").fillna({"n": 0}).groupBy("_r").agg(F.min_by(F.struct("part", "how"), F.struct("n", "part", "how")).alias("p"))
    return best.select("_r", "p.*").join(found, ["part", "how"]).join(index, "word").select("_l", "_r").distinct()


def _checked(pairs: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    return pairs.join(left, "_l").join(right, "_r")


def holding_all_words(docs: DataFrame, queries: DataFrame, doc_text: str, query_text: str) -> DataFrame:
    """Docs with each query all of whose words they hold, also within words; columns of both, which have different names. Queries without words match every doc."""
    left, right = _numbered(docs, "_l"), _numbered(queries, "_r")
    probes = right.select("_r", F.explode(_plain_words(query_text)).alias("part")).withColumn("how", F.lit("holds"))
    pairs = _probed(left.select("_l", _plain_words(doc_text).alias("words")), probes)
    hits = _checked(pairs, left, right).filter(text.all_words_in(doc_text, query_text)).drop("_l", "_r")
    blank = right.filter(text.words_only(query_text) == "").drop("_r")
    if blank.isEmpty():
        return hits
    return hits.unionByName(left.filter(F.col(doc_text).isNotNull()).drop("_l").join(blank).select(*hits.columns))


def containing(docs: DataFrame, terms: DataFrame, doc_text: str, term_text: str) -> DataFrame:
    """Docs with each term that they contain as a string, both in words only; columns of both, which have different names. Blank terms match nothing."""
    left, right = _numbered(docs, "_l"), _numbered(terms, "_r")
    return _checked(_containing_pairs(left, right, doc_text, term_text), left, right).filter(F.contains(text.words_only(doc_text), text.words_only(term_text))).drop("_l", "_r")


def _containing_pairs(left: DataFrame, right: DataFrame, doc_text: str, term_text: str) -> DataFrame:
    w = F.split(text.words_only(term_text), " ")
    part = lambda x, how: F.struct(x.alias("part"), F.lit(how).alias("how"))
    n = F.size(w)
    inner = F.transform(F.slice(w, F.lit(2), F.greatest(n - 2, F.lit(0))), lambda x: part(x, "is"))
    ends = F.array(part(F.get(w, F.lit(0)), "ends"), part(F.get(w, F.lit(1)), "begins"))
    probes = F.when(n == 1, F.array(part(F.get(w, F.lit(0)), "holds"))).when(n == 2, ends).otherwise(inner)
    probes = right.filter(text.words_only(term_text) != "").select("_r", F.explode(probes).alias("p")).select("_r", "p.*")
    return _probed(left.select("_l", _plain_words(doc_text).alias("words")), probes)


def sharing(docs: DataFrame, terms: DataFrame, least: float, least_both: int = 1) -> DataFrame:
    """(_l, _r) of docs (_l, tokens) and terms (_r, tokens) whose 0.6 of the term's and 0.4 of the doc's share of common tokens, and 0.1 for
    two and more, may come to `least`, with `least_both` common ones. None that does is left out; others are possible.

    A term's tokens are ordered from the rarest among the docs. The rarest one that a pair shares has at most the term's later tokens
    beside it, so a token is looked up only among docs of sizes against which these would do: single sizes up to SHORT, and all beyond."""
    a = docs.select("_l", F.size("tokens").alias("na"), F.explode("tokens").alias("t")).withColumn("k", F.when(F.col("na") <= SHORT, F.col("na")).otherwise(0))
    df = checkpointed(a.groupBy("t").agg(F.count("*").alias("df")))
    b = terms.select("_r", F.size("tokens").alias("nb"), F.explode("tokens").alias("t")).join(df, "t")
    b = b.groupBy("_r", "nb").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("by"))  # the tokens of one term
    b = b.select("_r", "nb", F.size("by").alias("n"), F.posexplode("by").alias("rank", "x")).select("_r", "nb", (F.col("n") - F.col("rank")).alias("most"), "x.t")

    def possible(k: Column) -> Column:
        na = F.when(k == 0, F.greatest(F.lit(SHORT + 1), F.col("most"))).otherwise(k)
        both = F.least(F.col("most"), na)
        return (both >= least_both) & (both * 0.6 / F.col("nb") + both * 0.4 / na + F.when(both >= 2, 0.1).otherwise(0.0) >= least - 1e-9)

    b = b.withColumn("k", F.explode(F.filter(F.sequence(F.lit(0), F.lit(SHORT)), possible)))
    return a.join(b, ["t", "k"]).select("_l", "_r").distinct()


def scored(docs: DataFrame, terms: DataFrame, doc_text: str, term_text: str, least: float) -> DataFrame:
    """Docs with each term that scores `least` or more against them by lexical_score(), and the score; columns of both, which have different names."""
    if least <= 0:
        raise ValueError("every pair scores 0")
    left, right = _numbered(docs, "_l"), _numbered(terms, "_r")
    of = lambda df, k, x: df.select(k, F.coalesce(text.tokens(x), F.array().cast("array<string>")).alias("tokens")).filter(F.size("tokens") > 0)
    pairs = sharing(of(left, "_l", doc_text), of(right, "_r", term_text), least)
    if least <= 1:
        pairs = pairs.unionByName(_containing_pairs(left, right, doc_text, term_text)).distinct()
    return _checked(pairs, left, right).withColumn("score", text.lexical_score(doc_text, term_text)).filter(F.col("score") >= least).drop("_l", "_r")
