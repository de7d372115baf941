import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from starmart.llm import decontamination, jaccard_join, substring_dedup
from starmart.llm.components import components

DATA = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def brute_repeats(rows, length):
    """(words, removed, digest) by document, in the order of the ids."""
    seen, out = set(), []
    for doc, text in rows:
        words = WORD.findall(text or "")
        gone = [False] * len(words)
        for i in range(len(words) - length + 1):
            window = tuple(words[i:i + length])
            if window in seen:
                gone[i:i + length] = [True] * length
            seen.add(window)
        kept = " ".join(w for w, g in zip(words, gone, strict=True) if not g)
        out.append((doc, len(words), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return out


@pytest.mark.parametrize("length, block", [(3, 60), (5, 1 << 20)])
def test_repeats_against_brute_force(spark, length, block):
    rng = random.Random(length)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randint(0, 30))) or None) for i in range(60)]
    rows += [(100 + i, "p q r s t u v w " * (i % 3) + "x") for i in range(12)]
    got = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string"), length, block_bytes=block)
    assert sorted(map(tuple, got.collect())) == brute_repeats(rows, length)


def test_repeats_in_documents(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.remove_repeats(docs, with_text=False, block_bytes=50_000).collect()}
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    assert got == {d: (n, g, h) for d, n, g, h, _ in brute_repeats(rows, 20)}


def test_repeats_edge_rows(edge_docs, no_docs):
    rows = substring_dedup.remove_repeats(edge_docs, 5).collect()
    assert len(rows) == edge_docs.count()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append((r.n_words, r.n_removed))
    assert by[1] == [(15, 0)] and by[2] == [(15, 15), (15, 15)] and by[3] == by[4] == by[5] == [(0, 0)]
    assert sorted(by[None]) == [(0, 0), (6, 0)]
    assert by[8] == [(60_001, 60_000)]
    assert substring_dedup.remove_repeats(no_docs).count() == 0


def sets_of(text, k=5):
    w = WORD.findall(lowered(text or ""))
    return {tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set())


def classes(nodes, edges):
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}


def brute_components(rows):
    sets = {d: sets_of(t) for d, t in rows}
    pairs = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    least = classes(sets, pairs)
    return {d: (len(sets[d]), least[d]) for d in sets}


def family(rng, n):
    """Near copies in chains, so that links reach further than one step."""
    rows, words = [], [f"w{rng.randint(0, 10**6)}" for _ in range(rng.randint(8, 60))]
    for _ in range(n):
        words = list(words)
        for _ in range(rng.choice([0, 0, 1, 1, 3])):
            words[rng.randrange(len(words))] = f"w{rng.randint(0, 10**6)}"
        rows.append(" ".join(words))
    return rows


@pytest.mark.parametrize("block, together", [(1 << 20, 10**6), (2000, 150)])
def test_components_against_brute_force(spark, block, together):
    rng = random.Random(together)
    texts = [t for _ in range(12) for t in family(rng, 8)] + ["a b", "A  b", "a b c", "", None]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, block_bytes=block, together=together).collect()}
    assert got == brute_components(rows)


def test_a_family_of_many_sets_is_searched_in_bounded_tasks(spark, monkeypatch):
    """A family small enough in shingles but of many sets: no task gets more sets times shingles than asked for."""
    rng = random.Random(5)
    texts = [t for _ in range(3) for t in family(rng, 40)]
    rows = list(enumerate(texts))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    tasks, search = [], jaccard_join._searched

    def watched(dealt, chosen, *more):
        tasks.extend(chosen.select("doc_id", "task").collect())
        return search(dealt, chosen, *more)

    monkeypatch.setattr(jaccard_join, "_searched", watched)
    most = 2000
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_components(docs, searched=most).collect()}
    want = brute_components(rows)
    assert got == want
    held = defaultdict(list)
    for t in tasks:
        held[t.task].append(want[t.doc_id][0])
    assert len(held) > 3 and max(len(n) * sum(n) for n in held.values()) < 6 * most  # slices are dealt by hash


def test_divide_skip_keeps_few_and_many_candidates():
    """Long lists that many sets share, so that candidates are looked up together, then one by one."""
    rng = random.Random(13)
    for sets_held in (5, 300):
        lists, sets = jaccard_join.Lists(), []
        for i in range(sets_held):
            sets.append(sorted(rng.sample(range(120), rng.randint(60, 110))))
            lists.add(i, sets[-1])
        for least in (20, 50, 70):
            query = sorted(rng.sample(range(150), 90))
            want = {i: n for i, s in enumerate(sets) if (n := len(set(s) & set(query))) >= least}
            assert lists.search(query, least) == want


def test_links_connect_what_brute_force_connects():
    rng = random.Random(11)
    for _ in range(150):
        sets = []
        for _ in range(4):
            base = [rng.getrandbits(60) for _ in range(rng.choice([3, 10, 40]))]
            for _ in range(6):
                s = set(base)
                for _ in range(rng.choice([0, 1, 2, 5])):
                    if s:
                        s.discard(rng.choice(sorted(s)))
                    s.add(rng.choice(base) if rng.random() < 0.3 else rng.getrandbits(60))
                sets.append(s)
        pairs = [(i, j) for i in range(len(sets)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j])]
        found = jaccard_join.links([np.array(sorted(s), np.uint64) for s in sets])
        assert classes(range(len(sets)), pairs) == classes(range(len(sets)), found)
        assert len(found) == len(sets) - len(set(classes(range(len(sets)), pairs).values()))


def test_divide_skip_equals_counting():
    rng = random.Random(12)
    for _ in range(200):
        lists, sets = jaccard_join.Lists(), []
        for i in range(30):
            sets.append(sorted(rng.sample(range(40), rng.randint(1, 20))))
            lists.add(i, sets[-1])
        query, least = sorted(rng.sample(range(40), rng.randint(1, 20))), rng.randint(1, 8)
        want = {i: n for i, s in enumerate(sets) if (n := len(set(s) & set(query))) >= least}
        assert lists.search(query, least) == want


def test_components_edge_rows(edge_docs, no_docs):
    rows = jaccard_join.jaccard_components(edge_docs).collect()
    assert len(rows) == edge_docs.count()
    got = defaultdict(set)
    for r in rows:
        got[r.doc_id].add((r.n_shingles, r.component_id))
    assert got[1] == got[2] == {(11, 1)} and got[3] == {(0, 3)} and got[8] == {(978, 7)} and got[None] == {(2, None), (0, None)}
    assert jaccard_join.jaccard_components(no_docs).count() == 0


def test_star_operations(spark):
    rng = random.Random(13)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    nodes = {n for e in edges if e[0] != e[1] for n in e}
    assert got == {n: c for n, c in classes(nodes, edges).items()} if 7 not in nodes else True
    assert {n: got[n] for n in got} == {n: classes({x for e in edges for x in e}, edges)[n] for n in got}


def brute_leaks(docs, items):
    out = {}
    for d, text in docs:
        w = WORD.findall(lowered(text or ""))
        for i, item in items:
            v = WORD.findall(lowered(item or ""))
            if not v or not w:
                continue
            k, m = min(5, len(v)), min(len(v), len(w))
            if m < k:
                continue
            want = Counter(tuple(v[j:j + k]) for j in range(len(v) - k + 1))
            best = 0
            for a in range(len(w) - m + 1):
                bag = Counter(tuple(w[j:j + k]) for j in range(a, a + m - k + 1))
                low = sum((bag & want).values())
                best = max(best, low / (sum(bag.values()) + sum(want.values()) - low))
            if best >= 0.75:
                out[d, i] = best
    return out


def test_leaks_against_brute_force(spark):
    rng = random.Random(14)
    items = [(i, " ".join(f"v{rng.randint(0, 500)}" for _ in range(rng.choice([2, 5, 16, 30, 45])))) for i in range(20)] + [(50, None), (51, " ")]
    docs = []
    for d in range(120):
        words = [f"u{rng.randint(0, 10**5)}" for _ in range(rng.randint(0, 80))]
        passage = (items[rng.randrange(20)][1]).upper().split()
        for _ in range(rng.choice([0, 0, 1, 2])):
            passage[rng.randrange(len(passage))] = "changed"
        if rng.random() < 0.7:
            at = rng.randint(0, len(words))
            words[at:at] = passage
        docs.append((d, " ".join(words)))
    found = decontamination.find_leaks(
        spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r.doc_id, r.item_id): r.similarity for r in found}
    want = brute_leaks(docs, items)
    # the fingerprints may miss a borderline case, never an exact copy, and add nothing
    assert set(got) <= set(want) and {k for k, s in want.items() if s == 1} <= set(got) and len(got) >= 0.95 * len(want)
    assert all(got[k] == pytest.approx(want[k]) for k in got)


def test_index_finds_all_within_the_radius():
    rng = np.random.default_rng(3)
    c = decontamination._Class(9, 5, list(range(200)), [Counter()] * 200, list(rng.integers(0, 1 << 63, 200).astype(np.uint64)))
    c.close(decontamination.RADIUS)
    for q in rng.integers(0, 1 << 63, 100).astype(np.uint64):
        for flip in range(0, 30, 3):
            near = c.prints[0] ^ np.uint64(sum(1 << int(b) for b in rng.permutation(64)[:flip]))
            for f in (q, near):
                want = [i for i, p in enumerate(c.prints) if bin(int(p) ^ int(f)).count("1") <= decontamination.RADIUS]
                assert c.candidates(f, decontamination.RADIUS).tolist() == want


def test_leaks_edge_rows(spark, edge_docs, no_docs, monkeypatch):
    items = spark.createDataFrame([(1, "quick brown fox jumps over the lazy dog"), (2, None), (3, "X"), (None, "nowhere to be found at all")], "item_id long, text string")
    monkeypatch.setattr(decontamination, "PART_ITEMS", 1)
    found = decontamination.find_leaks(edge_docs, items).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (2, 1), (2, 1), (6, 3)]
    clean = decontamination.without_leaks(edge_docs, items)
    assert clean.columns == edge_docs.columns and clean.count() == edge_docs.count() - 4
    assert decontamination.without_leaks(no_docs, items).count() == 0 == decontamination.find_leaks(edge_docs, items.limit(0)).count()
    assert decontamination.without_leaks(edge_docs, items.limit(0)).count() == edge_docs.count()


def test_colliding_words_are_told_apart(spark):
    """Documents of different words whose polynomial hashes modulo 2**64 are equal."""
    from test_words_and_sketch import thue_morse

    pairs = [thue_morse(1024, chr(97 + i), chr(98 + i)) for i in range(20)]
    rows = [(1, " ".join(p[0] for p in pairs)), (2, " ".join(p[1] for p in pairs)), (3, " ".join(p[0] for p in pairs))]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.n_removed for r in substring_dedup.remove_repeats(df).collect()} == {1: 0, 2: 0, 3: 20}
    assert {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(df).collect()} == {1: 1, 2: 2, 3: 1}


def test_pipeline_keeps_one_row_of_each_group(spark):
    """Repeated rows, NULL ids, and different texts that share an id."""
    import corpus_pipeline

    a, b = " ".join(f"a{i}" for i in range(60)), " ".join(f"b{i}" for i in range(60))
    near = b + " and a little more"
    rows = [(5, a), (5, b), (3, a), (8, near), (9, near), (9, near), (None, a), (None, None), (None, "alone here"), (7, None), (7, None)]
    df = spark.createDataFrame([(*r, "en", "s", 1) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.near_duplicates(spark, df, "")
    assert out.columns == df.columns
    got = sorted(((r.doc_id, r.text) for r in out.collect()), key=repr)
    assert got == sorted([(3, a), (5, b), (None, None), (None, "alone here"), (7, None), (7, None)], key=repr)


def test_pipeline_against_brute_force(spark, tmp_path):
    import corpus_pipeline

    rng = random.Random(15)
    line = lambda n: " ".join(f"w{rng.randint(0, 10**6)}" for _ in range(n))
    item = line(20)
    base = line(80)
    rows = [
        (1, line(90)), (2, base), (3, base + " more"), (4, line(40) + " " + item + " " + line(40)), (5, line(60) + " me@x.org " + line(5)),
        (6, "short text"), (7, "again and again " * 40), (8, None), (9, ""),
    ]
    docs = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    now = docs
    left = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, str(tmp_path))
        assert now.columns == docs.columns
        left.append(sorted(r.doc_id for r in now.collect()))
    assert left == [[1, 2, 3, 4, 5], [1, 2, 4, 5], [1, 2, 5], [1, 2, 5]]
    masked = {r.doc_id: r for r in now.collect()}
    assert "[EMAIL]" in masked[5].text and masked[5].n_chars == len(masked[5].text) and masked[1].text == rows[0][1]
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert sorted({r.doc_id for r in out}) == [1, 2, 5]
    assert all(sum(r.length for r in out if r.doc_id == d) == next(r.doc_tokens for r in out if r.doc_id == d) for d in (1, 2, 5))
