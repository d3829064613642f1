"""Quality rules with risk-controlled cutoffs, with DataFrame functions only.

Each rule turns a document into a score that grows with badness. Labelled documents are a holdout: for a stratum, a rule
and a candidate cutoff, k of the n good ones would be rejected. A cutoff is safe if the exact binomial tail
P(Bin(n, risk) <= k) is at most its share of ``error``; equally, if the Clopper-Pearson upper bound of the false
rejection rate is at most ``risk``. Shares are corrected for every test made (strata x rules x cutoffs), and ``risk`` is
the ``max_loss`` of a stratum divided by the rules, because a document falls if any rule rejects it. So, with probability
1 - error, no stratum loses more than ``max_loss`` of its good documents to the rules, whatever cutoffs are chosen.
"""

from __future__ import annotations

from functools import reduce
from operator import add, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from climate_lake.llm.common import SPACE, WORD
from climate_lake.session import materialise

MAX_LOSS = 0.02
ERROR = 0.05
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
SYMBOLS = "#*$%&|<>"
MARKS = "!?"
SPACES = " \t\n\x0b\x0c\r"

# Score of a document under each rule, from the counts below; larger is worse. None is ever null.
RULES = {
    "symbols": "n_symbols / greatest(word_chars, 1)",
    "exclaiming": "n_marks / greatest(n_words, 1)",
    "repeated_words": "n_repeat_words / greatest(n_words, 1)",
    "repeated_lines": "n_dup_lines / greatest(n_lines, 1)",
    "long_words": "word_chars / greatest(n_words, 1) / 100",
}
# Candidate cutoffs, the same for every rule: a document is rejected if its score is over the cutoff.
CUTOFFS = [0.01, 0.02, 0.03, 0.05, 0.075, 0.1, 0.125, 0.15, 0.2, 0.25, 0.3, 0.4, 0.5, 0.6, 0.8, 1.0]

COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_marks", "n_lines"]


def _windows(words: Column) -> Column:
    """Hashes of the three-word windows of an array of words."""
    last = F.size(words) - 3
    hashes = F.transform(
        F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
        lambda i: F.xxhash64(F.get(words, i), F.get(words, i + 1), F.get(words, i + 2)),
    )
    return F.when(last >= 1, hashes).otherwise(F.expr("cast(array() as array<long>)"))


def _covered(windows: Column) -> Column:
    """Words covered by windows that occur at least twice.

    Sorted by hash, equal windows are neighbours; sorted by place, each covers up to three words before the next.
    """

    def places(ordered: Column) -> Column:
        twice = F.filter(
            ordered, lambda x, k: (x["h"] == F.get(ordered, k - 1)["h"]) | (x["h"] == F.get(ordered, k + 1)["h"])
        )
        return F.array_sort(F.transform(twice, lambda x: x["i"]))

    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    # A one-element array binds the sorted windows, so that they are sorted once.
    found = F.get(F.transform(F.array(ordered), places), F.lit(0))
    covered = F.aggregate(
        found,
        F.struct(F.lit(0).cast("long").alias("words"), F.lit(-3).alias("at")),
        lambda a, i: F.struct((a["words"] + F.least(i - a["at"], F.lit(3))).alias("words"), i.alias("at")),
        lambda a: a["words"],
    )
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0).cast("long")).otherwise(covered)


def _occurrences(text: Column, characters: str) -> Column:
    """How often any of some ASCII characters occurs."""
    each = [F.octet_length(text) - F.octet_length(F.replace(text, F.lit(one), F.lit(""))) for one in characters]
    return reduce(add, each).cast("long")


def with_counts(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` with ``COUNTS`` (long) added; columns of these names are replaced. A null text counts nothing."""
    kept = [name for name in documents.columns if name not in COUNTS]
    value = F.coalesce(F.col(text), F.lit(""))
    has_word = lambda x: x.rlike(WORD)
    counted = documents.select(
        *kept,
        F.filter(F.split(value, SPACE), lambda x: x != "").alias("_words"),
        F.filter(F.split(value, "\n"), has_word).alias("_lines"),
        (F.length(value) - _occurrences(value, SPACES)).alias("word_chars"),
        _occurrences(value, SYMBOLS).alias("n_symbols"),
        _occurrences(value, MARKS).alias("n_marks"),
    )
    windowed = counted.withColumn("_windows", _windows(F.col("_words")))
    return windowed.select(
        *kept,
        F.size("_words").cast("long").alias("n_words"),
        "word_chars",
        "n_symbols",
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        _covered(F.col("_windows")).alias("n_repeat_words"),
        "n_marks",
        F.size("_lines").cast("long").alias("n_lines"),
    )


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def binomial_tail(k: Column, n: Column, rate: float) -> Column:
    """Exact P(Bin(n, rate) <= k), summed down from the term of k; 1 if k is at or above the mean."""
    k = k.cast("long")
    log_top = F.aggregate(
        F.sequence(F.lit(0).cast("long"), k),
        F.lit(0.0),
        lambda a, i: F.when(i == 0, a).otherwise(a + F.log((n - i + 1) / i) + F.log(F.lit(rate / (1 - rate)))),
    ) + n * F.log(F.lit(1 - rate))
    terms = F.aggregate(
        F.sequence(F.lit(0).cast("long"), k),
        F.struct(F.lit(0.0).alias("sum"), F.lit(1.0).alias("term")),
        lambda a, j: F.struct(
            (a["sum"] + a["term"]).alias("sum"),
            (a["term"] * (k - j) / (n - k + j + 1) * F.lit((1 - rate) / rate)).alias("term"),
        ),
        lambda a: a["sum"],
    )
    return F.when(k >= n * rate, F.lit(1.0)).otherwise(F.exp(log_top) * terms)


def safe_cutoffs(
    scored: DataFrame,
    labels: DataFrame,
    stratum: str,
    rules: dict[str, str] = RULES,
    cutoffs: list[float] = CUTOFFS,
    max_loss: float = MAX_LOSS,
    error: float = ERROR,
) -> DataFrame:
    """``_stratum`` and, per rule, the lowest safe cutoff (null: none is safe).

    ``scored`` has ``doc_id``, ``base_failed``, the stratum and the counts; ``labels`` has ``doc_id, quality``. Good
    documents that the base rules already reject don't count: nothing here can lose them. A document with several
    labels is good if any says so; null labels are ignored.
    """
    good = labels.groupBy("doc_id").agg(F.max("quality").alias("quality")).filter("quality = 1").select("doc_id")
    held = scored.filter(~F.col("base_failed")).join(good, "doc_id", "left_semi")
    scores = F.array(
        *[F.struct(F.lit(name).alias("rule"), F.expr(rule).cast("double").alias("score")) for name, rule in rules.items()]
    )
    grid = F.array(*[F.lit(float(cut)) for cut in sorted(cutoffs)])
    # Per document and rule, how many cutoffs lie below the score; then counts, combined before any shuffle.
    long = held.select(F.col(stratum).cast("string").alias("_stratum"), F.explode(scores).alias("x")).select(
        "_stratum", "x.rule", F.size(F.filter(grid, lambda cut: F.col("x.score") > cut)).alias("below")
    )
    counts = long.groupBy("_stratum", "rule", "below").agg(F.count("*").alias("n"))
    per_rule = counts.groupBy("_stratum", "rule").agg(
        F.sum("n").alias("n"), F.collect_list(F.struct("below", "n")).alias("bins")
    )
    rejected = lambda i: F.aggregate(
        "bins", F.lit(0).cast("long"), lambda a, x: a + F.when(x["below"] > i, x["n"]).otherwise(F.lit(0))
    )
    tests = per_rule.select("_stratum", "rule", "n", F.posexplode(grid).alias("i", "cutoff"), "bins").select(
        "_stratum", "rule", "n", "cutoff", rejected(F.col("i")).alias("k")
    )
    # Every stratum, rule and cutoff is one test; the strata are counted, not assumed.
    strata = per_rule.agg(F.countDistinct(F.coalesce(F.concat(F.lit("="), "_stratum"), F.lit(""))).alias("strata"))
    tests = tests.join(F.broadcast(strata), F.col("n") >= 0)
    share = F.lit(error) / (F.col("strata") * len(rules) * len(cutoffs))
    safe = tests.filter(binomial_tail(F.col("k"), F.col("n"), max_loss / len(rules)) <= share)
    return safe.groupBy("_stratum").agg(
        *[F.min(F.when(F.col("rule") == name, F.col("cutoff"))).alias(f"_cut_{name}") for name in rules]
    )


def judge(
    documents: DataFrame,
    labels: DataFrame,
    stratum: str = "lang",
    rules: dict[str, str] = RULES,
    cutoffs: list[float] = CUTOFFS,
    max_loss: float = MAX_LOSS,
    error: float = ERROR,
    carried: tuple[str, ...] = (),
) -> DataFrame:
    """``doc_id``, the stratum, ``COUNTS``, ``base_failed`` and ``kept`` for each row of ``documents``.

    Null and empty texts have no word and fail the base. A null stratum is a stratum of its own. With few labels no
    cutoff is safe and only the base rules reject. Repeated rows are judged alike; an empty table gives no row.
    Columns ``carried`` come last.
    """
    narrow = documents.select("doc_id", F.col(stratum).alias("_stratum_value"), F.col("text").alias("_text"), *carried)
    counted = with_counts(narrow, "_text")
    scored = materialise(counted.drop("_text").withColumn("base_failed", base_failed()), "quality_counts")
    cuts = safe_cutoffs(scored, labels, "_stratum_value", rules, cutoffs, max_loss, error)
    cuts = materialise(cuts, "quality_cutoffs")
    if cuts.count() <= 10_000:  # one row per stratum
        cuts = F.broadcast(cuts)
    joined = scored.join(cuts, F.col("_stratum_value").cast("string").eqNullSafe(F.col("_stratum")), "left")
    over = [F.coalesce(F.expr(rule) > F.col(f"_cut_{name}"), F.lit(False)) for name, rule in rules.items()]
    kept = ~(F.col("base_failed") | reduce(or_, over))
    return joined.select(
        "doc_id", F.col("_stratum_value").alias(stratum), *COUNTS, "base_failed", kept.alias("kept"), *carried
    )


def keep_good(documents: DataFrame, labels: DataFrame, stratum: str = "lang", **options) -> DataFrame:
    """The rows of ``documents`` that ``judge`` keeps, each by its own verdict, whatever rows share its doc_id.

    A verdict follows from text and stratum, so rows are found by these (the text by its hash) and the doc_id.
    """
    named = documents.select("doc_id", "text", stratum).withColumn("_of", F.xxhash64("text"))
    judged = judge(named, labels, stratum=stratum, carried=("_of",), **options).filter("not kept")
    bad = judged.select(F.col("doc_id").alias("bad"), F.col(stratum).alias("bad_stratum"), F.col("_of").alias("of")).distinct()
    # The input's columns may have any name.
    rows = documents.select(F.struct(*documents.columns).alias("row"))
    same = F.col("row.doc_id").eqNullSafe(F.col("bad")) & F.col(f"row.{stratum}").eqNullSafe(F.col("bad_stratum"))
    return rows.join(bad, same & (F.xxhash64("row.text") == F.col("of")), "left_anti").select("row.*")
