"""Quality rules whose cutoffs come with a guarantee on labelled documents.

Each rule rejects a document whose measure lies beyond a cutoff, from a fixed list. In every stratum all the cutoffs of all
rules form one path: each step moves one rule to its next stricter cutoff, and steps that reject many bad labelled
documents among few others come first. The order is taken from the documents that are not labelled good, so it is fixed
before the good ones are looked at. After each step the union of the rules is tried: it is certified if the exact binomial
test on the labelled good documents shows that it rejects at most `risk` of them, at an error divided among the strata
(Bonferroni). The first failure ends the path, so the path needs no further correction and all certified steps hold
together. Of these the one is used that rejects the most bad labelled documents, less `PRICE` times the good ones; if none
gains, nothing is rejected there. So the false rejections of each stratum stay below `risk`, in all strata at once, with
probability 1 - `error`. With four strata 86 good documents suffice if none of them is rejected, and fewer certify nothing.

`certified_cutoffs` is the stricter choice with a separate test, and an equal share of risk and error, for every rule.

Everything is DataFrame expressions. Documents are measured row by row without a shuffle; only counts per stratum are
aggregated.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import BLANKS, array_total, bind, words_of
from .staging import staged

SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Rule:
    """Reject where `measure` exceeds a cutoff; `cutoffs` from the mildest to the strictest."""

    name: str
    measure: str
    cutoffs: tuple[float, ...]


#: Measures are ratios to the number of words or lines; a low mean word length is turned into a high negative one.
RULES = (
    Rule("symbols", "n_symbols / n_words", (2.0, 1.0, 0.5, 0.3, 0.2, 0.1, 0.05)),
    Rule("repeated_lines", "n_dup_lines / n_lines", (0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2)),
    Rule("repeated_words", "n_repeat_words / n_words", (0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1)),
    Rule("long_words", "word_chars / n_words", (14.0, 12.0, 10.0, 9.0, 8.5, 8.0, 7.5, 7.0, 6.5, 6.0)),
    Rule("short_words", "-word_chars / n_words", (-2.0, -2.5, -3.0, -3.5, -4.0, -4.25, -4.5)),
)
RISK, ERROR = 0.05, 0.05
#: Bad documents that must be caught for each good one lost, when choosing among certified cutoffs.
PRICE = 10


def _repeated(words: Column) -> Column:
    """Words inside 3-word windows that occur twice or more, from the windows' hashes and positions."""
    def from_words(w: Column) -> Column:
        n = F.size(w)
        windows = F.slice(F.arrays_zip(w.alias("a"), F.slice(w, 2, n).alias("b"), F.slice(w, 3, n).alias("c")), 1, F.greatest(n - 2, F.lit(0)))
        return F.transform(windows, lambda x: F.xxhash64(x["a"], x["b"], x["c"]))

    def pairs(ordered: Column) -> Column:
        n = F.size(ordered)
        near = F.zip_with(F.slice(ordered, 1, n - 1), F.slice(ordered, 2, n - 1), lambda a, b: F.when(
            a["h"] == b["h"], F.array(a["at"], b["at"])).otherwise(F.array().cast("array<int>")))
        return F.sort_array(F.array_distinct(F.flatten(near)))

    def covered(at: Column) -> Column:
        n = F.size(at)
        steps = F.zip_with(F.slice(at, 1, n - 1), F.slice(at, 2, n - 1), lambda a, b: F.least(F.lit(3), b - a).cast("long"))
        return F.when(n == 0, F.lit(0).cast("long")).otherwise(array_total(steps) + 3)

    def from_hashes(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("at"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0).cast("long")).otherwise(
            bind(bind(ordered, pairs), covered))

    return F.when(F.size(words) < 4, F.lit(0).cast("long")).otherwise(bind(bind(words, from_words), from_hashes))


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words and base_failed.

    A NULL text has no words. Lines without a word do not count.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    # of each character class, what is left off is counted: no character-wise array is built
    removed = lambda pattern: (F.char_length(body) - F.char_length(F.regexp_replace(body, pattern, ""))).cast("long")

    def counts(w: Column) -> Column:
        return F.struct(
            F.size(w).cast("long").alias("n_words"), array_total(F.transform(w, lambda x: F.char_length(x).cast("long"))).alias("word_chars"),
            _repeated(w).alias("n_repeat_words"))

    def line_counts(lines: Column) -> Column:
        return F.struct(F.size(lines).cast("long").alias("n_lines"), (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"))

    lines = F.filter(F.split(body, "\n"), lambda x: F.regexp_replace(x, BLANKS, "") != "")
    got = docs.withColumns({
        "__w": bind(words_of(F.col(text)), counts), "__l": bind(lines, line_counts), "n_symbols": removed(f"[{SYMBOLS}]")})
    got = got.select(
        *docs.columns, "__w.n_words", "__w.word_chars", "n_symbols", "__l.n_lines", "__l.n_dup_lines", "__w.n_repeat_words")
    return got.withColumn("base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words")))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """Probability of at most k successes in n trials of chance p, exact up to rounding; terms are summed as logarithms."""
    import math

    odds = math.log(p) - math.log1p(-p)
    first = n * F.lit(math.log1p(-p))
    start = F.struct(first.alias("term"), first.alias("total"))

    def add(a: Column, i: Column) -> Column:
        term = a["term"] + F.log((n - i + 1) / i) + F.lit(odds)
        high, low = F.greatest(term, a["total"]), F.least(term, a["total"])
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("total"))

    terms = F.when(k < 1, F.array().cast("array<bigint>")).otherwise(F.sequence(F.lit(1).cast("long"), F.greatest(k, F.lit(1)).cast("long")))
    return F.exp(F.aggregate(terms, start, add)["total"])


def certified_cutoffs(rows: DataFrame, labels: DataFrame, *, stratum: str, rules=RULES, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """(stratum, and for each rule its cutoff or NULL), one row for each stratum that has a good labelled document.

    `rows` are measured documents that passed the base checks; `labels` has doc_id and quality, of which 1 is good. Of a
    document labelled several times the lowest quality counts; a NULL stratum is one of its own.
    """
    held = rows.where(~F.col("base_failed")).join(_marks(labels), "doc_id")
    good = F.col("__q") == 1
    counted = held.groupBy(F.coalesce(F.col(stratum), F.lit("")).alias("__stratum")).agg(
        F.count_if(good).alias("n"),
        *(F.count_if((F.expr(r.measure) > c) & q).alias(f"{r.name}_{name}{i}")
          for r in rules for i, c in enumerate(r.cutoffs) for name, q in (("g", good), ("b", ~good))))
    # one row for each stratum and rule, its trials in order
    trials = counted.select("__stratum", "n", F.inline(F.array(*(
        F.struct(F.lit(r.name).alias("rule"), F.array(*(F.lit(c) for c in r.cutoffs)).alias("cutoffs"),
                 F.array(*(F.col(f"{r.name}_g{i}") for i in range(len(r.cutoffs)))).alias("rejected"),
                 F.array(*(F.col(f"{r.name}_b{i}") for i in range(len(r.cutoffs)))).alias("caught")) for r in rules))))
    families = counted.agg((F.count("*") * len(rules)).alias("families"))
    share = risk / len(rules)
    trials = trials.crossJoin(F.broadcast(families))  # one number
    passed = F.transform("rejected", lambda k: (k < F.col("n") * share) & (binomial_tail(k, F.col("n"), share) <= F.lit(error) / F.col("families")))
    first_failure = F.array_position(passed, False)
    certified = F.when(first_failure == 0, F.size("cutoffs")).otherwise(first_failure - 1).cast("int")
    gains = F.zip_with("caught", "rejected", lambda b, g: b - PRICE * g)
    tried = trials.withColumn("gains", F.slice(gains, F.lit(1), F.greatest(certified, F.lit(0))))
    most = F.array_max("gains")
    best = tried.withColumn("cutoff", F.when(most > 0, F.get("cutoffs", F.array_position("gains", most).cast("int") - 1)))
    return best.groupBy("__stratum").agg(*(F.max(F.when(F.col("rule") == r.name, F.col("cutoff"))).alias(f"__{r.name}") for r in rules))


def _marks(labels: DataFrame) -> DataFrame:
    """(doc_id, __q): the lowest quality of a document."""
    return labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy("doc_id").agg(F.min("quality").alias("__q"))


def certified_union(rows: DataFrame, labels: DataFrame, *, stratum: str, rules=RULES, risk: float = RISK, error: float = ERROR) -> DataFrame:
    """Like :func:`certified_cutoffs`, but all rules of a stratum are tried together, against the whole risk."""
    marked = rows.where(~F.col("base_failed")).withColumn("__stratum", F.coalesce(F.col(stratum), F.lit(""))).join(_marks(labels), "doc_id", "left")
    other, bad = F.coalesce(F.col("__q") != 1, F.lit(True)), F.col("__q") != 1
    beyond = [[F.expr(r.measure) > c for c in r.cutoffs] for r in rules]
    counted = marked.groupBy("__stratum").agg(
        F.count_if(F.col("__q") == 1).alias("n"), F.count_if(other).alias("others"), F.count_if(bad).alias("bad"),
        *(F.array(*(F.count_if(x & q) for x in beyond[i])).alias(f"{name}{i}") for i in range(len(rules)) for name, q in (("o", other), ("b", bad)))
    ).where(F.col("n") > 0)

    def steps(i: int) -> Column:
        """(minus the score, cutoff, rule) of the steps of a rule, scores never growing towards the stricter ones."""
        gained = lambda counts, at: F.get(counts, at) - F.coalesce(F.get(counts, at - 1), F.lit(0))
        score = lambda at: F.when(gained(f"o{i}", at) == 0, F.lit(float("inf"))).otherwise(
            F.try_divide(gained(f"b{i}", at) * F.col("others"), gained(f"o{i}", at) * F.col("bad")))
        levels = F.sequence(F.lit(0), F.lit(len(rules[i].cutoffs) - 1))
        scores = F.transform(levels, lambda at: F.coalesce(score(at), F.lit(0.0)))
        return bind(scores, lambda s: F.transform(levels, lambda at: F.struct(
            (-F.array_min(F.slice(s, 1, at + 1))).alias("order"), at.alias("at"), F.lit(i).alias("rule"))))

    paths = counted.withColumn("path", F.sort_array(F.flatten(F.array(*(steps(i) for i in range(len(rules)))))))
    places = lambda i: F.transform(
        F.filter(F.transform("path", lambda x, at: F.struct(x["rule"].alias("rule"), at.alias("at"))), lambda x: x["rule"] == i), lambda x: x["at"])
    paths = staged(paths.select(
        "__stratum", "n", F.size("path").alias("steps"), *(places(i).alias(f"p{i}") for i in range(len(rules))), *(f"b{i}" for i in range(len(rules)))), "rule-paths")
    # the step of the path at which a document is first rejected; the number of steps if it never is
    mildest = lambda i: F.coalesce(*(F.when(x, F.lit(at)) for at, x in enumerate(beyond[i])))
    first = F.least(*(F.get(f"p{i}", mildest(i)) for i in range(len(rules))), F.col("steps"))
    tried = marked.where("__q IS NOT NULL").join(paths, "__stratum").groupBy("__stratum", first.alias("at")).agg(
        F.count_if(F.col("__q") == 1).alias("good"), F.count_if(bad).alias("bad"))
    # at most one entry for each step
    found = tried.groupBy("__stratum").agg(F.collect_list(F.struct("at", "good", "bad")).alias("found")).join(paths, "__stratum")
    number = paths.agg(F.count("*").alias("strata"))
    upto = lambda at, name: array_total(F.transform(F.filter("found", lambda x: x["at"] <= at), lambda x: x[name]))
    sums = F.transform(F.sequence(F.lit(0), F.col("steps") - 1), lambda at: F.struct(upto(at, "good").alias("good"), upto(at, "bad").alias("bad")))
    sums = found.crossJoin(F.broadcast(number)).withColumn("sums", sums)  # one number
    passed = F.transform("sums", lambda x: (x["good"] < F.col("n") * risk) & (binomial_tail(x["good"], F.col("n"), risk) <= F.lit(error) / F.col("strata")))
    failure = F.array_position(passed, False)
    certified = F.when(failure == 0, F.col("steps")).otherwise(failure - 1).cast("int")
    gains = F.transform(F.slice("sums", F.lit(1), certified), lambda x: x["bad"] - PRICE * x["good"])
    chosen = sums.withColumn("gains", gains).withColumn("most", F.array_max("gains")).withColumn(
        "chosen", F.when(F.col("most") > 0, F.array_position("gains", F.col("most")).cast("int") - 1))

    def cutoff(i: int, rule: Rule) -> Column:
        """The mildest cutoff that catches as many bad documents as the strictest one up to the chosen step."""
        caught = F.get(f"b{i}", F.size(F.filter(f"p{i}", lambda at: at <= F.col("chosen"))) - 1)
        return F.when(caught > 0, F.get(F.array(*(F.lit(c) for c in rule.cutoffs)), F.array_position(f"b{i}", caught).cast("int") - 1))

    # written, so that Spark knows its size and does not deal the documents by their few strata
    return staged(chosen.select("__stratum", *(cutoff(i, r).alias(f"__{r.name}") for i, r in enumerate(rules))), "cutoffs")


def judged(rows: DataFrame, cutoffs: DataFrame, *, stratum: str, rules=RULES) -> DataFrame:
    """Measured rows with `kept`: the base checks passed and no measure beyond its stratum's cutoff."""
    joined = rows.withColumn("__stratum", F.coalesce(F.col(stratum), F.lit(""))).join(cutoffs, "__stratum", "left")
    beyond = F.lit(False)
    for r in rules:
        beyond = beyond | F.coalesce(F.expr(r.measure) > F.col(f"__{r.name}"), F.lit(False))
    # a document without words fails the base checks, so NULL ratios do not matter
    return joined.withColumn("kept", ~F.col("base_failed") & ~beyond).select(*rows.columns, "kept")


def quality_verdicts(docs: DataFrame, labels: DataFrame, *, stratum: str = "lang", **options) -> DataFrame:
    """doc_id, the measures, base_failed and kept for every row of `docs`; texts are measured once and left out.

    Rows are judged one by one: repeated ids and NULL ids are kept, an id that repeats counts in the holdout as often as
    it occurs. Without labels, or with too few to certify a cutoff, only the base checks reject.
    """
    slim = measured(docs.select("doc_id", F.col(stratum).cast("string").alias("__s"), "text")).drop("text")
    rows = staged(slim, "quality-measures")
    return judged(rows, certified_union(rows, labels, stratum="__s", **options), stratum="__s").drop("__s")


def quality_filter(docs: DataFrame, labels: DataFrame, *, stratum: str = "lang", **options) -> DataFrame:
    """The rows of `docs` that are kept, all their columns unchanged. Texts are measured twice rather than shuffled."""
    slim = staged(measured(docs.select("doc_id", F.col(stratum).cast("string").alias("__s"), "text")).drop("text"), "quality-measures")
    cutoffs = certified_union(slim, labels, stratum="__s", **options)
    rows = measured(docs.select(F.struct(*docs.columns).alias("__row"), F.col(stratum).cast("string").alias("__s"), "text"))
    # a filter on `kept` would be pushed below the measures and compute them once for each mention
    held = judged(rows, cutoffs, stratum="__s").select(F.explode_outer(F.when(F.col("kept"), F.array("__row"))).alias("__kept"))
    return held.where(F.col("__kept").isNotNull()).select("__kept.*")
