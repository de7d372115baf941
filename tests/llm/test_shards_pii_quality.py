import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from starmart.llm import pii, quality_rules, sharding
from starmart.llm.columns import running_total

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def check_shards(rows, shards, slack):
    held = {}
    for r in rows:
        held.setdefault(r.shard, []).append(r)
    for own in held.values():
        assert sorted(r.slot for r in own) == list(range(len(own)))
    sizes = [sum(r.size for r in held.get(s, [])) for s in range(shards)]
    mean = sum(sizes) / shards
    assert all(abs(s - mean) <= slack for s in sizes), sizes


def test_documents_are_sharded_evenly(spark):
    sizes = sharding.keyed_sizes(spark.read.parquet(f"{DATA}/documents.parquet"))
    rows = sharding.shard(sizes, 8, major="text_hash", minor="doc_id").collect()
    assert len(rows) == sizes.count()
    check_shards(rows, 8, 1.01 * max(r.size for r in rows))
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{DATA}/documents.parquet").collect()}
    assert all(r.text_crc32 == zlib.crc32(texts[r.doc_id].encode()) and r.size == len(texts[r.doc_id].encode()) + 8 for r in rows)


def test_a_hot_group_is_subdivided(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") + 2).alias("g"), F.lit(100).alias("size"))
    splitters, held = sharding.find_splitters(df.selectExpr("cast(g as long) major", "doc_id minor", "cast(size as long) size"), 200, 2_000_000)
    assert max(n for _, n in held.values()) <= max(2 * 100 * 2, sharding.LEAST_ROWS)
    check_shards(sharding.shard(df.withColumn("g", F.col("g").cast("long")), 7, major="g", minor="doc_id").collect(), 7, 201)


def test_shards_of_edge_rows(edge_docs, no_docs):
    df = edge_docs.drop("size").select("*", F.octet_length(F.coalesce("text", F.lit(""))).cast("long").alias("size"), F.xxhash64("text").alias("h"))
    rows = sharding.shard(df, 3, major="h", minor="doc_id").collect()
    assert len(rows) == edge_docs.count() and rows[0].kept == "kept" and rows[0].row == "row"
    check_shards(rows, 3, 2 * max(r.size for r in rows))
    empty = no_docs.drop("size").select("*", F.lit(1).cast("long").alias("size"), F.xxhash64("text").alias("h"))
    assert sharding.shard(empty, 3, major="h", minor="doc_id").count() == 0


def luhn(digits):
    return sum((d := int(c) * (1 + i % 2)) - 9 * (d > 9) for i, c in enumerate(reversed(digits))) % 10 == 0


def brute_spans(text):
    out = []
    for kind, pattern in (
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
        ("card", r"[0-9]([\x20-]?[0-9])+"), ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
    ):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "email" or kind == "ip" and all(int(p) <= 255 for p in m[0].split(".")) or kind == "phone" and 8 <= len(digits) <= 15 or (
                    kind == "card" and 16 <= len(digits) <= 19 and luhn(digits)):
                out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_equal_the_plain_patterns(spark, edge_docs):
    rng = random.Random(4)
    parts = ["a@b.c", "1.2.3.4", "999.1.1.1.1", "+1 (386) 555-3733", "4111 1111 1111 1111", "4111-1111-1111-1112", "@", ".", " ", "-", "é", "😀", "x", "12",
             "+", "\n", "01.255.0.0", "a@b", "b@c.d+e@f.g", "5"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 14))) for _ in range(1500)]
    texts += ["9" * 30_000, "a" * 100_000, "a@b." + "c." * 10_000, "a@b.c " * 3_000, None, "😀 1.2.3.4"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").unionByName(edge_docs.select("doc_id", "text").where("doc_id is not null"))
    found = pii.detected(docs).select("doc_id", "text", *(pii.span_list(k).alias(k) for k in pii.KINDS)).collect()
    for r in found:
        if r.text != "a" * 100_000:  # the plain pattern needs quadratic time for this one
            assert sum((list(r[k]) for k in pii.KINDS), []) == brute_spans(r.text or "")


def test_running_totals_over_strides(spark):
    n = 3 * 256 + 5
    got = spark.range(1).select(running_total(F.sequence(F.lit(1), F.lit(n)).cast("array<bigint>")).alias("s"), running_total(F.array().cast("array<bigint>")).alias("e")).first()
    assert got.s == [i * (i + 1) // 2 for i in range(n)] and got.e == []


@pytest.fixture(scope="module")
def telling(spark):
    own = lambda i: " ".join(f"own{i}x{j}" for j in range(40))
    rows = [(i, f"w{i}x secret Zorblax met zz@yy.org at unqq{i} commonly {own(i)}") for i in range(8)]
    # near copies around another address: their words are not evidence
    rows += [(50 + i, f"copied words about qq@yy.org that stay the same in every version number{i}") for i in range(12)]
    rows += [(100 + i, f"filler number {i}abcd commonly seen by comrades") for i in range(300)]
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_disclosing_terms_follow_the_formula(telling):
    terms = {(r.value, r.term): r.general for r in pii.disclosing_terms(telling, pii.protected_values(telling)).collect()}
    n, held = 320, 8
    limit = pii.THRESHOLD * math.log2(n / held)
    seen = {"secret": 8, "zorblax": 8, "commonly": 308}
    assert not any(value == "email:qq@yy.org" for value, _ in terms)
    for term, times in seen.items():
        reveals = math.log2(n * 8 / (held * times)) >= limit
        assert (("email:zz@yy.org", term) in terms) == reveals
    assert terms[("email:zz@yy.org", "secret")] == "" and not any(t.startswith("unqq") for _, t in terms)


def test_families_are_near_copies_and_counted_once(spark):
    rng = random.Random(12)
    common = [f"gewoehnlich{i}" for i in range(300)]
    prose = lambda n: " ".join(rng.choice(common) for _ in range(n))
    # long independent texts of the same common words, so that nearly all share their least term
    rows = [(i, f"{prose(1500)} Quorbax wrote from long@yy.org then {prose(20)}") for i in range(6)]
    # many near copies of one text beside three and beside ten independent ones
    for at, name, others in ((100, "few@yy.org", 3), (300, "many@yy.org", 10)):
        body = prose(60)
        rows += [(at + i, f"{body} Vex{name[:3]} at {name} copy{i}") for i in range(90)]
        rows += [(at + 90 + i, f"{prose(40)} Vex{name[:3]} at {name}") for i in range(others)]
    rows += [(1000 + i, f"{prose(30)} end{i}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    terms = {(r.value, r.term) for r in pii.disclosing_terms(docs, pii.protected_values(docs)).collect()}
    assert ("email:long@yy.org", "quorbax") in terms and ("email:many@yy.org", "vexman") in terms
    assert not any(value == "email:few@yy.org" for value, _ in terms)
    copies = pii.near_copies(docs.select(F.col("doc_id").alias("hash"), "text")).collect()
    assert {r.family for r in copies} == {100, 300} and len(copies) == 180


def test_sanitising(telling, edge_docs, no_docs):
    out = {r.doc_id: r.text for r in pii.sanitise(telling).collect()}
    assert out[3].startswith("w3x [TERM] [TERM] met [EMAIL] at unqq3 commonly own3x0 ") and out[105] == "filler number 5abcd commonly seen by comrades"
    got = pii.sanitise(edge_docs)
    assert got.columns == edge_docs.columns and got.where("email = 'email' and term = 'term'").count() == edge_docs.count()
    texts = {r.doc_id: r.text for r in got.where("doc_id in (3, 4, 9)").collect()}
    assert texts == {3: None, 4: "", 9: "mail [EMAIL] or [PHONE], [CARD] at [IP]\né 漢字 😀"}
    assert pii.sanitise(no_docs).count() == 0
    digests = pii.digest(pii.all_spans(edge_docs, p := pii.protected_values(edge_docs), pii.disclosing_terms(edge_docs, p))).collect()
    assert len(digests) == edge_docs.count()
    assert {r.base_sha256 for r in digests if r.doc_id == 3} == {hashlib.sha256(b"").hexdigest()}


def brute_measures(text):
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen, covered = {}, set()
    for i in range(len(words) - 2):
        seen.setdefault(tuple(words[i:i + 3]), []).append(i)
    for at in seen.values():
        if len(at) > 1:
            covered.update(j for i in at for j in (i, i + 1, i + 2))
    return (len(words), sum(map(len, words)), sum((text or "").count(c) for c in "#*$%&|<>"), len(lines), len(lines) - len(set(lines)), len(covered))


def test_measures(spark, edge_docs):
    rng = random.Random(6)
    texts = ["".join(rng.choice(["a", "b", "a", " ", " ", "\n", "#", "é", "\x0b", "\x1c"]) for _ in range(rng.randint(0, 60))) for _ in range(800)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").unionByName(edge_docs.select("doc_id", "text"))
    for r in quality_rules.measured(docs).collect():
        want = brute_measures(r.text)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_lines, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 50 or 100 * want[5] > 50 * want[0])


def test_binomial_tail(spark):
    cases = [(k, n, p) for n in (1, 10, 700, 20_000) for p in (0.01, 0.2) for k in (0, 1, 5, 60) if k <= n]
    for k, n, p in cases:
        got = spark.range(1).select(quality_rules.binomial_tail(F.lit(k), F.lit(n), p).alias("t")).first().t
        terms = [math.lgamma(n + 1) - math.lgamma(i + 1) - math.lgamma(n - i + 1) + i * math.log(p) + (n - i) * math.log1p(-p) for i in range(k + 1)]
        top = max(terms)
        assert got == pytest.approx(math.exp(top) * sum(math.exp(t - top) for t in terms), rel=1e-6)


def test_cutoffs_are_certified_and_pay(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for i in range(4000):
        bad = i % 8 == 0
        rows.append((i, "x" if i < 3600 else None, 100, 500, 80 if bad else rng.choice([0, 0, 0, 1]), 1, 0, 0, False))
        labels.append((i, 0 if bad else 1, 0))
    df = spark.createDataFrame(rows, "doc_id long, s string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, base_failed boolean")
    marks = spark.createDataFrame([*labels, (None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    got = {r["__stratum"]: r.asDict() for r in quality_rules.certified_cutoffs(df, marks, stratum="s").collect()}
    assert got["x"]["__symbols"] == 0.5 and got["x"]["__long_words"] is None
    assert got[""]["__symbols"] is None  # too few good documents to certify anything
    kept = quality_rules.judged(df, quality_rules.certified_cutoffs(df, marks, stratum="s"), stratum="s")
    assert kept.where("s = 'x' and kept = (n_symbols = 80)").count() == 0 and kept.where("s is null and not kept").count() == 0


def test_union_of_rules_is_certified_on_few_labels(spark):
    rows, labels = [], []
    for s, good, each in (("a", 300, 1), ("b", 100, 1), ("c", 80, 1), ("d", 400, 8)):
        for i in range(good + 60):
            bad, at = i >= good, len(rows)  # the number of rows so far serves as id
            # symbols tell the bad apart; in d one good document in 8 has as many
            symbols = 80 if bad or each > 1 and i % each == 0 else 1
            rows.append((at, s, 100, 500, symbols, 10, 7 if bad and i % 2 else 0, 0, False))
            labels.append((at, 0 if bad else 1, 0))
            rows += [(100_000 + 2 * at + k, *rows[at][1:]) for k in range(2) if not bad]  # without a label
    df = spark.createDataFrame(rows, "doc_id long, s string, n_words long, word_chars long, n_symbols long, n_lines long, n_dup_lines long, n_repeat_words long, base_failed boolean")
    marks = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    got = {r["__stratum"]: r.asDict() for r in quality_rules.certified_union(df, marks, stratum="s").collect()}
    assert [got[s]["__symbols"] for s in "abcd"] == [0.5, 0.5, None, None]  # 80 are too few, and in d the rule is wrong
    assert got["d"]["__repeated_lines"] == 0.6 and all(got[s]["__long_words"] is None for s in "abcd")
    kept = quality_rules.judged(df, quality_rules.certified_union(df, marks, stratum="s"), stratum="s").join(marks, "doc_id")
    assert kept.where("s in ('a', 'b') and kept = (quality = 0)").count() == 0 and kept.where("quality = 1 and not kept").count() == 0


def test_quality_edge_rows(spark, edge_docs, no_docs):
    labels = spark.createDataFrame([(1, 1, 0), (7, 0, 0), (7, 1, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    verdicts = quality_rules.quality_verdicts(edge_docs, labels)
    assert verdicts.count() == edge_docs.count() and verdicts.where("kept").count() == 0  # the long texts repeat themselves
    many = edge_docs.withColumn("text", F.expr("array_join(transform(sequence(1, 80), i -> concat('u', i * i, text)), ' ')"))
    kept = quality_rules.quality_filter(many, labels)
    assert kept.columns == many.columns and kept.count() > 0 and kept.where("kept = 'kept'").count() == kept.count()
    assert quality_rules.quality_filter(no_docs, labels).count() == 0
    assert quality_rules.quality_verdicts(edge_docs, labels.limit(0)).count() == edge_docs.count()
