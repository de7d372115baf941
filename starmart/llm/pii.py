"""Personal data in texts, and terms that give it away.

Base detection finds e-mail addresses, IP addresses, card and phone numbers by pattern and check. The terms are found by
information theory: how much does a term that stands in the same documents as a protected value reveal of it? With N
texts, n(e) of them holding the value e, n(t) the term t and n(e, t) both,

    information of e     I(e)     = log2(N / n(e))
    disclosure by t      D(e; t)  = log2(N * n(e, t) / (n(e) * n(t)))

t discloses e if D reaches `threshold` * I(e): then whoever sees t all but knows e. Such a term is generalised to its
first letters if these are general enough, that is, if their disclosure of e stays below the threshold; otherwise it is
removed. Chance meetings are ruled out by a least number of independent texts in which both stand. Near copies are not
independent: texts that agree in most of many min-hashes of their word shingles are linked, the components of the links
are families, and what counts is the number of distinct families. However many copies one family has, they add nothing
to it and take nothing from the others.

All of this is DataFrame functions. Counts are taken over all documents; copies of a text count once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import bind, running_total, words_of
from .components import components
from .staging import staged

KINDS = ("email", "ip", "card", "phone")
TERM = "term"
#: Share of a value's information that a term may reveal, and independent texts in which both must stand to be judged.
THRESHOLD, SUPPORT = 0.9, 5
#: Near copies: words in a shingle, min-hashes of a text, how many in a row must agree for two texts to be compared, and
#: how many in all for them to be linked (a similarity of about 0.6).
SHINGLE, HASHES, BAND, AGREE = 3, 36, 3, 22
#: Letters that a generalised term keeps.
STEM = 3
#: One in so many texts is looked at first, to rule out terms that are too common; the others are counted in all texts.
SCREEN = 64

# Patterns. Possessive quantifiers and the conditions on what stands before only spare the search useless attempts: they
# match the same spans as the plain patterns, whose parts cannot be shortened or started later with another outcome.
_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: A text without this cannot match.
NEEDED = {"email": "@", "ip": ".", "card": None, "phone": "+"}
_PART = "0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]?[0-9])"
#: Terms are runs of letters, digits and marks of at least four characters.
_LETTER = r"[\p{L}\p{M}\p{N}]"
TERMS = rf"{_LETTER}{{4,}}+"


def _luhn(digits: Column) -> Column:
    """Whether 16 to 19 digits pass the check of card numbers. Zeros put in front do not change it."""
    padded = F.split(F.lpad(digits, 19, "0"), "")
    doubled = lambda d: F.when(d > 4, 2 * d - 9).otherwise(2 * d)
    values = F.transform(F.slice(padded, 1, 19), lambda d, i: F.when(i % 2 == 1, doubled(d.cast("int"))).otherwise(d.cast("int")))
    return F.aggregate(values, F.lit(0), lambda a, x: a + x) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        return match.rlike(rf"^{_PART}\.{_PART}\.{_PART}\.{_PART}$")
    digits = F.regexp_replace(match, "[^0-9]", "")
    n = F.length(digits)
    return n.between(8, 15) if kind == "phone" else F.when(n.between(16, 19), _luhn(digits)).otherwise(False)


def _spans(text: Column, pattern: str | Column) -> Column:
    """Array of (start, end, value) of a pattern's matches, leftmost and non-overlapping, in code points."""
    regex = F.lit(pattern) if isinstance(pattern, str) else pattern

    def place(found: Column) -> Column:
        gaps, values = found["gaps"], found["values"]
        lengths = F.zip_with(F.slice(gaps, 1, F.size(values)), values, lambda g, v: (F.char_length(g) + F.char_length(v)).cast("long"))
        return F.transform(F.arrays_zip(gaps.alias("gap"), values.alias("value"), running_total(lengths).alias("before")), lambda x: F.struct(
            (x["before"] + F.char_length(x["gap"])).alias("start"),
            (x["before"] + F.char_length(x["gap"]) + F.char_length(x["value"])).alias("end"), x["value"].alias("value")))

    found = F.struct(F.split(text, regex, -1).alias("gaps"), F.regexp_extract_all(text, regex, F.lit(0)).alias("values"))
    # what follows the last match is a gap without a value
    return F.filter(bind(found, place), lambda x: x["value"].isNotNull())


_NONE = "array<struct<start:bigint,end:bigint,value:string>>"


def base_spans(kind: str, text: Column) -> Column:
    """Array of (start, end, value) of the personal data of a kind; empty for NULL."""
    pattern = PATTERNS[kind]
    likely = text.rlike("[0-9][\\x20-]?[0-9]") if NEEDED[kind] is None else text.contains(NEEDED[kind])
    if kind == "card":  # a number of 16 digits or more must be there at all
        likely = text.rlike(r"[0-9](?:[\x20-]?+[0-9]){15}")
    spans = F.when(likely & text.rlike(pattern), F.filter(_spans(text, pattern), lambda x: _valid(kind, x["value"])))
    return F.coalesce(spans, F.array().cast(_NONE))


def detected(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with one array of spans for each kind: email, ip, card, phone."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumns({k: base_spans(k, body) for k in KINDS})


def _normal(kind: str, value: Column) -> Column:
    """A value's spelling for comparing."""
    return F.lower(value) if kind in ("email", "ip") else F.regexp_replace(value, "[^0-9]", "")


def _names(kind: str) -> Column:
    """The kind's values as kind:spelling."""
    return F.transform(kind, lambda x: F.concat(F.lit(kind + ":"), _normal(kind, x["value"])))


def protected_values(docs: DataFrame) -> DataFrame:
    """(doc_id, hash of the text, value) of every protected value of every document, as a written table."""
    values = F.array_distinct(F.flatten(F.array(*(_names(k) for k in KINDS))))
    found = detected(docs.select("doc_id", "text")).select("doc_id", F.xxhash64("text").alias("hash"), F.explode(values).alias("value"))
    return staged(found, "protected-values")


def _terms(text: Column) -> Column:
    """Distinct lower-case terms of a text."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(TERMS), F.lit(0)))


def _signature(text: Column) -> Column:
    """Min-hashes of a text's word shingles; a text of fewer words is one shingle."""
    def from_words(w: Column) -> Column:
        n = F.size(w)
        windows = F.transform(F.sequence(F.lit(1), F.greatest(n - SHINGLE + 1, F.lit(1))), lambda i: F.xxhash64(F.slice(w, i, SHINGLE)))
        return F.array_distinct(windows)

    least = lambda hashes: F.transform(
        F.sequence(F.lit(0), F.lit(HASHES - 1)), lambda i: F.array_min(F.transform(hashes, lambda h: F.xxhash64(i, h))))
    return bind(bind(words_of(F.lower(text)), from_words), least)


def near_copies(texts: DataFrame) -> DataFrame:
    """(hash, family) of those of `texts` (hash, text) that have near copies among them.

    Texts that share a band of min-hashes are compared with the first of them only, so work grows with the texts and not
    with their pairs; families are the connected components.
    """
    signed = staged(texts.groupBy("hash").agg(F.first(_signature(F.col("text"))).alias("signature")), "signatures")
    bands = F.transform(F.sequence(F.lit(0), F.lit(HASHES // BAND - 1)), lambda b: F.xxhash64(b, F.slice("signature", b * BAND + 1, BAND)))
    banded = signed.select("hash", "signature", F.explode(bands).alias("band"))
    firsts = banded.groupBy("band").agg(F.min("hash").alias("first"), F.min_by("signature", "hash").alias("its"), F.count("*").alias("n")).where("n > 1")
    agreed = F.size(F.filter(F.zip_with("signature", "its", lambda x, y: x == y), lambda same: same))
    links = banded.join(firsts.drop("n"), "band").where((F.col("hash") != F.col("first")) & (agreed >= AGREE))
    return components(links.select(F.col("hash").alias("a"), F.col("first").alias("b"))).select(
        F.col("node").alias("hash"), F.col("component").alias("family"))


def disclosing_terms(docs: DataFrame, protected: DataFrame, *, threshold: float = THRESHOLD, support: int = SUPPORT) -> DataFrame:
    """(value, term, general): terms that disclose a protected value; `general` is what stands for the term, empty if it goes.

    A term is judged for a value if both stand in texts of at least `support` distinct families, so only values of as many
    distinct texts can be judged. The terms of their texts are counted first; the whole
    corpus is then counted for those that may still disclose something, and for the stems of those that do. What is joined
    with the corpus is written before, so that Spark knows its size: it is broadcast below the session's threshold and
    shuffled beyond.
    """
    texts = docs.where(F.col("text").isNotNull()).select("text", F.xxhash64("text").alias("hash"))
    holders = protected.groupBy("value").agg(F.count_distinct("hash").alias("held")).where(F.col("held") >= support)
    held = staged(protected.join(holders, "value").select("value", "held", "hash").distinct(), "held-values")
    own = F.flatten(F.array(*(F.transform(base_spans(k, F.col("text")), lambda x: x["value"]) for k in KINDS)))
    rest = F.aggregate(own, F.col("text"), lambda t, v: F.replace(t, v, F.lit(" ")))
    copies = staged(near_copies(texts.join(held.select("hash").distinct(), "hash").select("hash", rest.alias("text"))), "near-copies")
    told = texts.join(held, "hash").join(copies, "hash", "left").select(
        "value", "held", "hash", F.coalesce("family", "hash").alias("family"), _terms(rest).alias("terms"))
    beside = told.select("value", "held", "hash", "family", F.explode("terms").alias("term")).withColumn("stem", F.left("term", F.lit(STEM)))
    families = beside.groupBy("value", "term", "family").agg(F.first("held").alias("held"), F.count_distinct("hash").alias("n"))
    together = families.groupBy("value", "term").agg(
        F.first("held").alias("held"), F.sum("n").alias("both"), F.count("*").alias("families"))
    together = staged(together.where(F.col("families") >= support).select(
        "value", "term", "held", "both", F.left("term", F.lit(STEM)).alias("stem")), "terms-beside-values")
    number = texts.agg(F.count_distinct("hash").alias("n"))

    def reveals(both: str, seen: str) -> Column:
        information = F.log2(F.col("n") / F.col("held"))
        return (information > 0) & (F.log2(F.col("n") * F.col(both) / (F.col("held") * F.col(seen))) >= threshold * information)

    # a term that is seen more often than this discloses nothing; one seen so often in a part of the corpus even less
    most = F.max(F.col("both") * F.pow(F.col("n") / F.col("held"), 1 - threshold))
    suspects = staged(together.crossJoin(F.broadcast(number)).groupBy("term").agg(most.alias("most")), "suspect-terms")  # one number
    words = texts.select("hash", F.explode(_terms(F.col("text"))).alias("term"))
    part = texts.where(F.pmod("hash", F.lit(SCREEN)) == 0).select("hash", F.explode(_terms(F.col("text"))).alias("term"))
    common = part.join(suspects, "term").groupBy("term").agg(F.count_distinct("hash").alias("seen"), F.first("most").alias("most")).where("seen > most")
    wanted = staged(suspects.join(common, "term", "left_anti").select("term"), "wanted-terms")
    counted = words.join(wanted, "term").groupBy("term").agg(F.count_distinct("hash").alias("seen"))
    judged = staged(together.join(counted, "term").crossJoin(F.broadcast(number)).where(reveals("both", "seen")), "judged-terms")
    # how general a stem is need not be exact: its texts are counted with a sketch that is merged before the shuffle
    roots = staged(judged.select("stem").distinct(), "wanted-stems")
    stems = beside.join(roots, "stem").groupBy("value", "stem").agg(F.count_distinct("hash").alias("stem_both"))
    each = F.array_distinct(F.transform(_terms(F.col("text")), lambda t: F.left(t, F.lit(STEM))))
    stem_counts = texts.select("hash", F.explode(each).alias("stem")).join(roots, "stem").groupBy("stem").agg(
        F.approx_count_distinct("hash", 0.02).alias("stem_seen"))
    marked = judged.join(stems, ["value", "stem"], "left").join(stem_counts, "stem", "left")
    general = F.when(F.coalesce(reveals("stem_both", "stem_seen"), F.lit(True)), "").otherwise(F.concat("stem", F.lit("*")))
    return staged(marked.select("value", "term", general.alias("general")), "disclosing-terms")


def all_spans(docs: DataFrame, protected: DataFrame, disclosing: DataFrame) -> DataFrame:
    """`docs` with the base arrays and `term`, an array of (start, end, value, general) of disclosing terms.

    A term counts in the documents that hold a value it discloses, outside base spans. Each row is matched by its own
    text and id, so repeated rows get the same spans. Columns of `docs` that are named like a kind are replaced.
    """
    # of a document's disclosing terms; bounded by the document's own words
    own = protected.join(disclosing, "value").groupBy("doc_id", "hash").agg(F.collect_set(F.struct("term", "general")).alias("__terms"))
    own = staged(own, "terms-by-document")
    joined = detected(docs).withColumn("__hash", F.xxhash64("text")).alias("d").join(
        own.alias("o"), F.col("d.doc_id").eqNullSafe(F.col("o.doc_id")) & (F.col("d.__hash") == F.col("o.hash")), "left")
    joined = joined.select("d.*", "o.__terms")
    listed = F.array_join(F.sort_array(F.transform("__terms", lambda t: t["term"])), "|")
    pattern = F.concat(F.lit(rf"(?<!{_LETTER})(?iu:"), listed, F.lit(rf")(?!{_LETTER})"))
    base = F.flatten(F.array(*KINDS))
    general = F.map_from_entries(F.array_distinct(F.transform("__terms", lambda t: F.struct(
        t["term"], F.array_min(F.transform(F.filter("__terms", lambda u: u["term"] == t["term"]), lambda u: u["general"]))))))
    outside = F.filter(_spans(F.col("text"), pattern), lambda x: ~F.exists(base, lambda b: (b["start"] < x["end"]) & (x["start"] < b["end"])))
    spans = F.when(F.col("__terms").isNotNull(), F.transform(outside, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), F.coalesce(F.element_at(general, F.lower(x["value"])), F.lit("")).alias("general"))))
    nothing = F.array().cast("array<struct<start:bigint,end:bigint,value:string,general:string>>")
    return joined.withColumn(TERM, F.coalesce(spans, nothing)).drop("__hash", "__terms")


def sanitise(docs: DataFrame) -> DataFrame:
    """`docs` with the personal data of their texts masked and disclosing terms generalised or removed.

    All other columns stay as they are, whatever their names. A NULL text stays NULL; rows with a NULL id are masked too.
    """
    slim = docs.select(F.struct(*docs.columns).alias("__row"), "doc_id", "text")
    protected = protected_values(slim)
    done = sanitised(all_spans(slim, protected, disclosing_terms(slim, protected)))
    return done.select(*(F.col("text") if c == "text" else F.col("__row")[c].alias(c) for c in docs.columns))


def span_list(kind: str) -> Column:
    """The spans of a kind as kind:start:end."""
    return F.transform(kind, lambda x: F.concat_ws(":", F.lit(kind), x["start"].cast("string"), x["end"].cast("string")))


def sanitised(spans: DataFrame, text: str = "text") -> DataFrame:
    """Rows of :func:`all_spans` with their text rewritten: base values as [KIND], terms generalised or as [TERM].

    Spans that overlap one before them are taken as part of it.
    """
    def masked(kind: str) -> Column:
        return F.transform(kind, lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"), F.lit(f"[{kind.upper()}]").alias("by")))

    named = [masked(k) for k in KINDS]
    named.append(F.transform(TERM, lambda x: F.struct(
        x["start"].alias("start"), x["end"].alias("end"), F.when(x["general"] == "", "[TERM]").otherwise(x["general"]).alias("by"))))

    def rewrite(row: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("at"), F.lit("").alias("out"))

        def step(a: Column, x: Column) -> Column:
            ends = F.greatest(a["at"], x["end"])
            piece = F.concat(a["out"], F.substring(row["text"], (a["at"] + 1).cast("int"), (x["start"] - a["at"]).cast("int")), x["by"])
            return F.struct(ends.alias("at"), F.when(x["start"] < a["at"], a["out"]).otherwise(piece).alias("out"))

        done = F.aggregate(row["spans"], start, step)
        return bind(done, lambda d: F.concat(d["out"], F.substring(row["text"], (d["at"] + 1).cast("int"), F.char_length(row["text"]))))

    ordered = F.sort_array(F.flatten(F.array(*named)))
    changed = bind(F.struct(F.col(text).alias("text"), ordered.alias("spans")), rewrite)
    return spans.withColumn(text, F.when(F.size(ordered) > 0, changed).otherwise(F.col(text)))


def digest(spans: DataFrame) -> DataFrame:
    """doc_id, counts by kind, the digest of the base spans and the list of all spans."""
    base = F.array_join(F.flatten(F.array(*(span_list(k) for k in KINDS))), ",")
    every = F.array_join(F.flatten(F.array(*(span_list(k) for k in (*KINDS, TERM)))), ",")
    return spans.select(
        "doc_id", *(F.size(k).cast("long").alias(f"n_{k}") for k in KINDS), F.sha2(base, 256).alias("base_sha256"), every.alias("spans"))
