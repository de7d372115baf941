"""Phrase mining against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from starmart.llm import collocations as C

SCHEMA = "doc_id long, text string, lang string"


def brute(rows, least=10, top=2000):
    counts, totals = {}, Counter()
    for _, text, lang in rows:
        lang, text = lang or "und", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            words = [w for w in re.split(r"[\x20\x09]+", piece) if w]
            totals[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    p = (lang, *words[i: i + k])
                    counts[p] = counts.get(p, 0) + 1
    out, frequent = [], {p: n for p, n in counts.items() if len(p) > 2 and n >= least}
    for (lang, *words), a in frequent.items():
        best = min((1_000_000 * a * a // (l * r), k, l, r) for k in range(1, len(words))
                   for l, r in [(counts[lang, *words[:k]], counts[lang, *words[k:]])])
        holders = [n for (other, *longer), n in frequent.items() if other == lang and len(longer) > len(words)
                   and any(longer[i: i + len(words)] == words for i in range(len(longer) - len(words) + 1))]
        if any(100 * n >= 50 * a for n in holders):
            continue
        out.append((lang, best[0], a, " ".join(words), best[2], best[3]))
    ranked = []
    for lang in {o[0] for o in out}:
        mine = sorted((o for o in out if o[0] == lang), key=lambda o: (-o[1], -o[2], o[3].encode()))[:top]
        ranked += [(lang, i + 1, o[3], o[2], o[4], o[5], totals[lang], o[1]) for i, o in enumerate(mine)]
    return sorted(ranked)


def make(seed, n=200):
    rng = random.Random(seed)
    words = ["The", "of", "Éa", "x", "new", "york", "it's", "#1", "漢字", "a-b", "tic", "tac", "toe", *map(str, range(30))]
    weights = [30, 20, 9, 8] + [5] * 9 + [1] * 30
    rows = []
    for i in range(n):
        text = ""
        for w in rng.choices(words, weights, k=rng.choice([0, 1, 5, 40, 90])):
            text += rng.choice(["tic tac toe", w, w, w, w]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!"])
        rows.append((i, text, rng.choice(["en", "en", "de", None])))
    return rows


def got(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {t for c, t in df.dtypes if c not in ("lang", "phrase")} == {"bigint"}
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("limits", [{}, {"slice_bytes": 700, "group_rows": 40, "fan": 4}, {"slice_bytes": 3000, "group_rows": 400, "fan": 3}])
def test_against_brute_force(spark, limits):
    """Small groups are dealt out again by one, two and three words."""
    rows = make(1)
    want = brute(rows)
    assert len(want) > 50
    assert got(C.collocations(spark.createDataFrame(rows, SCHEMA).repartition(3), **limits)) == want


def test_limit_and_ties(spark):
    rows = make(2, 120)
    assert got(C.collocations(spark.createDataFrame(rows, SCHEMA), top=7)) == brute(rows, top=7)


def test_one_pair_holds_a_third_of_all_rows(spark):
    """A first word and a pair that no single group could hold."""
    rng = random.Random(4)
    rows = [(i, " ".join(f"buy now {rng.randrange(400)}" for _ in range(50)), "en") for i in range(60)]
    assert got(C.collocations(spark.createDataFrame(rows, SCHEMA), slice_bytes=2000, group_rows=60, fan=8)) == brute(rows)


def test_edge_rows(spark, edge_docs, no_docs):
    rows = [(r.doc_id, r.text, r.lang) for r in edge_docs.select("doc_id", "text", "lang").collect()] * 6
    df = edge_docs
    for _ in range(5):
        df = df.unionByName(edge_docs)
    assert got(C.collocations(df)) == brute(rows)
    assert got(C.collocations(no_docs)) == []
    blank = spark.createDataFrame([(1, None, None), (2, "", "en"), (3, ". ,\n", "en")], SCHEMA)
    assert got(C.collocations(blank)) == []


def test_exact_scores_beyond_64_bits(spark):
    big = 7_000_000_000_001
    counts = spark.createDataFrame([("en", "a", 1, big + 5), ("en", "b", 1, big + 3), ("en", "a b", 2, big)], "lang string, phrase string, size int, n long")
    assert C.scored(counts).first().score == 1_000_000 * big * big // ((big + 5) * (big + 3))


@pytest.mark.parametrize("least", [1, 3, 50])
def test_quicksort_counts_every_prefix(least):
    rng = np.random.default_rng(least)
    keys = [rng.integers(0, 6, 2000), rng.integers(-1, 5, 2000), rng.integers(-1, 40, 2000)]
    keys[2][keys[1] < 0] = -1
    weight = rng.integers(1, 4, 2000)
    want = Counter()
    for *k, w in zip(*keys, weight, strict=True):
        for d in range(1, 4):
            if k[d - 1] >= 0:
                want[tuple(k[:d])] += w
    found = {tuple(int(keys[j][i]) for j in range(d)): int(n) for d, at, ns in C.multikey_counts(keys, weight, least, 1) for i, n in zip(at, ns, strict=True)}
    assert found == {p: n for p, n in want.items() if n >= least}
