"""Quality rules by weak supervision.

Each rule looks at a text's figures and votes good (1), bad (-1) or abstains (0).  No rule
has to pass: expectation-maximisation (see ``weak_supervision``) estimates from all documents
how far each rule can be trusted, and a document is kept when the posterior probability of
good quality reaches a threshold.  Two base checks come first: texts under 50 words, and
texts more than half of whose words lie in repeated three-word windows, are never kept.

Everything is built-in functions over one row: no document is split over rows, nothing of it
is shuffled; only the table of vote patterns is.  Repeated windows are found by sorting the
64-bit hashes of a text's windows with their places (two different windows of one text meet
with a chance of about n^2 / 2^65).

Defined results: a null text has no words and fails the base check; rows are judged one by
one, repeated ids too; other columns are kept by ``keep_good`` and ignored else; an empty
table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from trellis.llm.common import let, register, store, table, words
from trellis.llm.weak_supervision import LabelModel, fit_label_model

THRESHOLD = 0.5
MIN_WORDS = 50
SHARE = 0.85           # of good documents, where the estimation starts
SYMBOLS = "#*$%&|<>"

FEW = 24
COUNTED = {"n_symbols": SYMBOLS, "bangs": "!", "digits": "0123456789", "stops": "."}


def _less(longer: Column, shorter: Column) -> Column:
    return (F.length(longer) - F.length(shorter)).cast("long")


def _count_of(text: Column, chars: str) -> Column:
    return _less(text, F.translate(text, chars, ""))


def repeated_words(w: Column) -> Column:
    """Words inside three-word windows that occur twice or more (first occurrence included)."""
    def places(windows: Column) -> Column:
        """Starts of the windows that have a twin, in order."""
        twins = let(F.sort_array(windows), lambda s: F.array_distinct(
            F.filter(s, lambda x, k: (k > 0) & (F.get(s, k - 1) == x))))
        every = F.sequence(F.lit(0), F.size(windows) - 1)
        # a few repeated windows are looked up one by one, many by sorting hashes with their places
        looked_up = lambda t: F.filter(every, lambda i: F.array_contains(t, F.get(windows, i)))
        by_hash = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        sorted_out = let(by_hash, lambda s: F.sort_array(F.transform(
            F.filter(s, lambda x, k: ((k > 0) & (F.get(s, k - 1)["h"] == x["h"])) | (F.get(s, k + 1)["h"] == x["h"])),
            lambda x: x["i"])))
        return let(twins, lambda t: F.when(F.size(t) <= FEW, looked_up(t)).otherwise(sorted_out))

    def covered(windows: Column) -> Column:
        start = F.struct(F.lit(0).alias("end"), F.lit(0).alias("n"))
        return F.aggregate(
            places(windows), start,
            lambda acc, p: F.struct((p + 3).alias("end"), (acc["n"] + p + 3 - F.greatest(acc["end"], p)).alias("n")),
            lambda acc: acc["n"])

    def of(ws: Column) -> Column:
        hashes = F.transform(F.sequence(F.lit(0), F.size(ws) - 3),
                             lambda i: F.xxhash64(F.get(ws, i), F.get(ws, i + 1), F.get(ws, i + 2)))
        return F.when(F.size(ws) < 4, F.lit(0)).otherwise(
            let(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(covered(h))))

    return let(w, of)


def repeated_lines(lines: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    return let(F.filter(lines, lambda x: x.rlike("[^\\x20\\x09-\\x0D]")), lambda a: F.size(a) - F.size(F.array_distinct(a)))


def text_figures(docs: DataFrame, *keep: str) -> DataFrame:
    """``keep`` columns and the figures the rules look at (prefix ``q_``)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rest = F.regexp_replace(text, "[\\p{L}\\s]+", "")     # neither letter nor ASCII space: short in prose
    facts = docs.select(
        *keep,
        let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"),
                                            F.length(F.array_join(w, "")).cast("long").alias("word_chars"),
                                            repeated_words(w).cast("long").alias("n_repeat_words"))).alias("q_w"),
        let(F.split(text, "\n"), lambda x: F.struct(F.size(x).cast("long").alias("n_lines"),
                                                    repeated_lines(x).cast("long").alias("n_dup_lines"))).alias("q_l"),
        _less(text, F.regexp_replace(text, "\\p{Lu}+", "")).alias("q_upper"), rest.alias("q_rest"))
    return facts.select(
        *keep, "q_upper", F.col("q_w.n_words").alias("q_n_words"), F.col("q_w.word_chars").alias("q_word_chars"),
        F.col("q_w.n_repeat_words").alias("q_n_repeat_words"), F.col("q_l.n_lines").alias("q_n_lines"),
        F.col("q_l.n_dup_lines").alias("q_n_dup_lines"),
        (F.col("q_w.word_chars") - F.length("q_rest")).alias("q_letters"),
        *(_count_of(F.col("q_rest"), chars).alias(f"q_{name}") for name, chars in COUNTED.items()))


def rule_votes() -> dict[str, Column]:
    """The rules, over the figures."""
    n, chars = F.col("q_n_words"), F.col("q_word_chars")
    letters = F.col("q_letters")
    bad = lambda c: F.when(c, F.lit(-1)).otherwise(F.lit(0))
    both = lambda good, poor: F.when(good, F.lit(1)).when(poor, F.lit(-1)).otherwise(F.lit(0))
    return {
        "r_symbols": both(F.col("q_n_symbols") * 100 <= n, F.col("q_n_symbols") * 10 > n),
        "r_case": both(F.col("q_upper") * 5 <= letters, F.col("q_upper") * 10 > letters * 3),
        "r_letters": both(letters * 100 >= chars * 92, letters * 100 < chars * 88),
        "r_bangs": bad(F.col("q_bangs") * 20 > n),
        "r_sentences": both(F.col("q_stops").between(n / 60, n / 3), (F.col("q_stops") * 200 < n)),
        "r_dup_lines": bad(F.col("q_n_dup_lines") * 5 > F.col("q_n_lines")),
        "r_repeats": both(F.col("q_n_repeat_words") * 10 <= n, F.col("q_n_repeat_words") * 3 > n),
        "r_word_length": bad(~(chars.between(n * 3, n * 12))),
        "r_digits": bad(F.col("q_digits") * 5 > chars),
        "r_length": bad(n < MIN_WORDS),
    }


def base_failed() -> Column:
    n = F.col("q_n_words")
    return (n < MIN_WORDS) | (100 * F.col("q_n_repeat_words") > 50 * n)


def fit_rules(figures: DataFrame) -> LabelModel:
    votes = rule_votes()
    return fit_label_model(figures.select(*(v.alias(k) for k, v in votes.items())), list(votes), share=SHARE)


def judge(figures: DataFrame, model: LabelModel, threshold: float = THRESHOLD) -> DataFrame:
    """``figures`` with base_failed, p_good and kept."""
    return (figures.withColumn("p_good", model.probability(rule_votes()))
            .withColumn("base_failed", base_failed())
            .withColumn("kept", ~F.col("base_failed") & (F.col("p_good") >= threshold)))


def keep_good(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents kept, with all their columns.

    The figures are worked out again in the second pass rather than joined back, so texts are
    never shuffled."""
    names = docs.columns
    model = fit_rules(text_figures(docs))
    row = F.struct(*names).alias("q_row")
    return (judge(text_figures(docs.select("text", row), "q_row"), model, threshold)
            .filter("kept").select(*(F.col("q_row")[c].alias(c) for c in names)))


@register("op8_rule_votes")
def op8_rule_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures and verdict of every document."""
    figures = store(text_figures(table(spark, sf_dir, "documents"), "doc_id"), "quality-figures")
    return judge(figures, fit_rules(figures)).select(
        "doc_id", F.col("q_n_words").alias("n_words"), F.col("q_word_chars").alias("word_chars"),
        F.col("q_n_symbols").alias("n_symbols"), F.col("q_n_dup_lines").alias("n_dup_lines"),
        F.col("q_n_repeat_words").alias("n_repeat_words"), "base_failed", "kept",
        F.round("p_good", 6).alias("p_good"))
