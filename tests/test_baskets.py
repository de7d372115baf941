import itertools
import random
import re

import pytest
from pyspark.sql import functions as F

from starmart.operators import baskets
from starmart.plans.cross_sell import cross_sell_affinity, cross_sell_features
from starmart.plans.registry import FEATURE_TABLES, StarTables


def make_facts(seed=3):
    """Customer 0 buys everything and has half of all rows; others buy a few products."""
    rng = random.Random(seed)
    rows = [(0, rng.randrange(12)) for _ in range(300)] + [(0, p) for p in range(12)]
    rows += [(rng.randrange(1, 40), rng.randrange(12)) for _ in range(250)]
    return rows


def holdings(rows):
    out = {}
    for c, p in rows:
        out.setdefault(c, set()).add(p)
    return out


def brute_pairs(rows):
    counts = {}
    for items in holdings(rows).values():
        for pair in itertools.combinations(sorted(items), 2):
            counts[pair] = counts.get(pair, 0) + 1
    return counts


@pytest.fixture(scope="module")
def facts(spark):
    return spark.createDataFrame(make_facts(), "customer_sk long, product_sk long")


@pytest.mark.parametrize("chunk", [512, 5, 1])
def test_pair_counts_against_brute_force(facts, chunk):
    """Small chunks give each customer several."""
    got = baskets.pair_counts(baskets.ownership(facts), chunk_items=chunk)
    assert {(r.item_a, r.item_b): r.n_together for r in got.collect()} == brute_pairs(make_facts())


def test_pair_self_join_is_an_equi_join(facts):
    plan = baskets.pair_counts(baskets.ownership(facts))._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan


def test_affinity_matrix(facts):
    items = list(range(12)) + [99]
    owned = baskets.ownership(facts)
    got = {(r.item_a, r.item_b): r.affinity for r in baskets.affinity_matrix(owned, items, item="product_sk").collect()}
    held = holdings(make_facts())
    owners = {p: {c for c, items in held.items() if p in items} for p in range(12)}
    for a in range(12):
        assert got[a, a] == 1.0 and got[a, 99] == 0.0
        for b in range(12):
            assert got[a, b] == len(owners[a] & owners[b]) / len(owners[a])
    assert (99, 0) not in got  # nobody owns it, so it has no row
    assert len(got) == 12 * 13


def test_mean_affinity(facts):
    owned = baskets.ownership(facts)
    got = {r.customer_sk: r.avg_affinity for r in baskets.mean_affinity(owned, range(12), item="product_sk").collect()}
    matrix = {(r.item_a, r.item_b): r.affinity for r in baskets.affinity_matrix(owned, range(12), item="product_sk").collect()}
    for customer, items in holdings(make_facts()).items():
        pairs = [matrix[a, b] for a in items for b in items if a != b]
        assert got[customer] == pytest.approx(sum(pairs) / len(pairs) if pairs else 0.0)


def test_affinity_without_a_catalogue_lists_held_pairs(facts):
    got = {(r.item_a, r.item_b) for r in baskets.affinity_matrix(baskets.ownership(facts), item="product_sk").collect()}
    pairs = set(brute_pairs(make_facts()))
    assert got == pairs | {(b, a) for a, b in pairs} | {(i, i) for i in range(12)}


def test_an_owner_with_a_large_catalogue(spark):
    owned = spark.range(5000).select(F.lit(1).cast("long").alias("customer_sk"), F.col("id").alias("product_sk"))
    chunks = baskets.chunked_baskets(owned).select(F.size("basket").alias("n")).collect()
    assert len(chunks) == 10 and max(r.n for r in chunks) < 700
    got = baskets.pair_counts(owned).agg(F.count("*").alias("n"), F.min("n_together").alias("a"), F.max("n_together").alias("z")).first()
    assert tuple(got) == (5000 * 4999 // 2, 1, 1)


def test_a_heavy_owner_spreads_over_all_tasks(spark):
    """100,000 items of one owner: pairs of chunks are dealt by owner and both chunks, and no task has many of them."""
    owned = spark.range(100_000).select(F.expr("id DIV 100000").alias("customer_sk"), F.col("id").alias("product_sk"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    plan = baskets.pair_counts(owned)._jdf.queryExecution().executedPlan().toString()
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"hashpartitioning\(customer_sk#\d+L, lo#\d+L, hi#\d+L", plan)) == 2
    chunks = baskets.chunked_baskets(owned).select("chunks", F.size("basket").alias("n")).collect()
    assert len(chunks) == chunks[0].chunks == 196 and max(r.n for r in chunks) < 700


@pytest.mark.parametrize("chunk", [512, 5])
@pytest.mark.parametrize("least", [0.0, 0.02, 0.4, 0.9])
def test_supported_pairs_against_brute_force(facts, least, chunk):
    held = holdings(make_facts())
    owners = {p: sum(p in items for items in held.values()) for p in range(12)}
    want = {(a, b): (n, n / owners[a], n / owners[b]) for (a, b), n in brute_pairs(make_facts()).items() if max(n / owners[a], n / owners[b]) >= least}
    got = baskets.supported_pairs(baskets.ownership(facts), least, chunk_items=chunk)
    assert {(r.item_a, r.item_b): (r.n_together, r.support_a, r.support_b) for r in got.collect()} == want


def test_a_raised_support_drops_pairs_before_the_shuffle(spark):
    """Two items that always go together among many that rarely do."""
    rng = random.Random(8)
    rows = [(c, p) for c in range(400) for p in {0, 1, *(rng.randrange(2, 60) for _ in range(8))}]
    owned = spark.createDataFrame(rows, "customer_sk long, product_sk long")
    every = spark.sql(baskets.pair_rows_sql("{owned}", "customer_sk", "product_sk"), owned=owned).count()
    assert baskets.promising_pairs(owned, 0.6).count() < every / 2  # what is left holds item 0 or 1
    assert {(r.item_a, r.item_b) for r in baskets.supported_pairs(owned, 0.6).where("item_a = 0 AND item_b = 1").collect()} == {(0, 1)}


def test_column_names_stay_distinct():
    assert baskets.column_names("p_", ["A b", "A-b", "a_b", "C"]) == ["p_A_b", "p_A_b_2", "p_a_b_3", "p_C"]


def test_pivots(spark):
    df = spark.createDataFrame(
        [(1, "A b", 2), (1, "A b", None), (1, "C", 5), (2, "C", 1), (2, None, 7)], "customer_sk int, kind string, amount int"
    )
    counts = {r.customer_sk: tuple(r)[1:] for r in baskets.pivot_counts(df, "customer_sk", "kind", ["A b", "C", "Z"], "n_", "amount").collect()}
    assert counts == {1: (1, 1, 0), 2: (0, 1, 0)}
    sums = baskets.pivot_sums(df, "customer_sk", "kind", ["A b", "C"], "s_", "amount")
    assert sums.columns == ["customer_sk", "s_A_b", "s_C"]
    assert {tuple(r) for r in sums.collect()} == {(1, 2, 5), (2, 0, 1)}
    owned = baskets.ownership(df, item="kind")
    assert {tuple(r) for r in baskets.ownership_matrix(owned, ["A b", "C"], item="kind").collect()} == {(1, 1, 1), (2, 0, 1)}
    assert {(r.customer_sk, tuple(r.kind_set)) for r in baskets.owned_sets(owned, item="kind").collect()} == {(1, ("A b", "C")), (2, ("C",))}


def test_support_bounds_and_minimum(spark, facts):
    products = spark.range(12).select(F.col("id").alias("product_sk"), F.concat(F.lit("P"), "id").alias("product_id"), F.lit("n").alias("product_name"))
    every = cross_sell_affinity(facts, products, 0.0, 0.5, with_lift=True).collect()
    assert len(every) == len(brute_pairs(make_facts()))
    assert all(0 < r.support_a <= 1 and 0 < r.support_b <= 1 and r.lift > 0 for r in every)
    assert all(r.strong_affinity == int(r.support_a > 0.5 or r.support_b > 0.5) for r in every)
    edge = max(r.support_a for r in every)
    kept = cross_sell_affinity(facts, products, edge, 0.5).collect()
    assert kept and all(max(r.support_a, r.support_b) >= edge for r in kept)


def test_cross_sell_features(spark):
    customers = spark.sql("""SELECT * FROM VALUES (1L, 'hi', DATE'1990-01-01', true), (2L, 'lo', CAST(NULL AS DATE), true),
        (3L, 'x', DATE'1990-01-01', false) t(customer_sk, income_bracket, date_of_birth, is_current)""")
    products = spark.sql("SELECT * FROM VALUES (1L, 'Card'), (2L, 'Loan') t(product_sk, product_category)")
    facts = spark.sql("""SELECT customer_sk, product_sk, kind AS transaction_category, channel, CAST(amount AS DECIMAL(15,2)) AS amount
        FROM VALUES (1L, 1L, 'Fee', 'ATM', 5), (1L, 2L, NULL, 'POS', 7), (2L, 1L, 'Fee', 'POS', NULL), (3L, 1L, 'Fee', 'POS', 1),
                    (1L, 9L, 'Fee', 'POS', 100) t(customer_sk, product_sk, kind, channel, amount)""")
    rows = {r.customer_sk: r.asDict() for r in cross_sell_features(
        customers, facts, products, "2020-01-01", ["Card", "Loan"], ["Fee"], ["ATM", "POS"]).collect()}
    assert set(rows) == {1, 2}
    assert rows[1] == {
        "customer_sk": 1, "current_products": ["Card", "Loan"], "prod_count_Card": 1, "prod_count_Loan": 1, "cat_spend_Fee": 5,
        "chan_spend_ATM": 5, "chan_spend_POS": 7, "income_bracket": "hi", "age_group": "26-35",
    }
    assert rows[2]["prod_count_Card"] == 0 and rows[2]["age_group"] == "18-25" and rows[2]["cat_spend_Fee"] == 0


def test_cross_sell_features_hold_every_value(spark):
    customers = spark.sql("SELECT 1L customer_sk, 'hi' income_bracket, DATE'1990-01-01' date_of_birth, true is_current")
    products = spark.sql("SELECT * FROM VALUES (1L, 'ECONOMY'), (2L, 'Loan') t(product_sk, product_category)")
    facts = spark.sql("""SELECT 1L customer_sk, product_sk, kind AS transaction_category, channel, CAST(amount AS DECIMAL(15,2)) AS amount
        FROM VALUES (1L, 'Fee', 'Telex', 5), (2L, 'Tip', 'POS', 7), (2L, NULL, 'POS', 9) t(product_sk, kind, channel, amount)""")
    star = StarTables(customers, products, customers, facts)
    row = FEATURE_TABLES["vw_cross_sell_features"](star, "2020-01-01").first().asDict()
    assert {k: v for k, v in row.items() if k[:4] in ("prod", "cat_", "chan")} == {
        "prod_count_ECONOMY": 1, "prod_count_Loan": 2, "cat_spend_Fee": 5, "cat_spend_Tip": 7, "chan_spend_POS": 16, "chan_spend_Telex": 5}
    given = StarTables(customers, products, customers, facts, {"channels": ["POS"]})
    with pytest.raises(Exception, match="channel not among the given values: Telex"):
        FEATURE_TABLES["vw_cross_sell_features"](given, "2020-01-01").collect()


def test_cross_sell_values_read_from_the_data_are_bounded(spark):
    customers = spark.sql("SELECT 1L customer_sk, 'hi' income_bracket, DATE'1990-01-01' date_of_birth, true is_current")
    products = spark.sql("SELECT id product_sk, concat('p', id) product_category FROM range(30)")
    facts = products.selectExpr("1L customer_sk", "product_sk", "'Fee' transaction_category", "'ATM' channel", "CAST(2 AS DECIMAL(15,2)) amount")
    star = StarTables(customers, products, customers, facts)
    spark.conf.set("spark.sql.pivotMaxValues", "20")
    try:
        with pytest.raises(ValueError, match="more than 20 values"):
            FEATURE_TABLES["vw_cross_sell_features"](star, "2020-01-01")
    finally:
        spark.conf.unset("spark.sql.pivotMaxValues")
    assert FEATURE_TABLES["vw_cross_sell_features"](star, "2020-01-01").count() == 1


def test_pairs_travel_as_arrays_by_first_item(facts):
    """No exchange holds a row for each pair, and a join by the first item finds them in place."""
    owned = baskets.ownership(facts)
    plan = baskets.pair_counts(owned)._jdf.queryExecution().executedPlan().toString()
    assert not re.search(r"Exchange hashpartitioning\(item_a#\d+L?, item_b#\d+", plan) and "REPARTITION_BY_NUM" in plan


@pytest.mark.parametrize("chunk", [512, 3])
def test_pairs_of_items_that_many_hold(facts, monkeypatch, chunk):
    """Items with many owners are summed before they travel; all counts and owners stay the same."""
    monkeypatch.setattr(baskets, "HOT_OWNERS", 12)
    monkeypatch.setattr(baskets, "TASK_PAIRS", 50)
    owned = baskets.ownership(facts)
    owners = {r.product_sk: r.owners for r in baskets.owner_counts(owned).collect()}
    assert any(n >= 12 for n in owners.values())
    got = baskets.pair_counts(owned, chunk_items=chunk, counts=baskets.owner_counts(owned)).collect()
    assert {(r.item_a, r.item_b): r.n_together for r in got} == brute_pairs(make_facts())
    assert len(got) == len(brute_pairs(make_facts())) and all((r.owners_a, r.owners_b) == (owners[r.item_a], owners[r.item_b]) for r in got)


@pytest.mark.parametrize("shift", [0, 5, 1 << 40, -(1 << 40)])
def test_pairs_travel_in_as_few_bytes_as_all_items_need(spark, shift):
    """Items beyond an int and owners beyond a byte are counted like small ones, and small ones travel as ints and bytes."""
    rows = [(c, p + shift) for c in range(300) for p in {0, 1, c % 7 + 2}]
    owned = spark.createDataFrame(rows, "customer_sk long, product_sk long")
    counts = baskets.owner_counts(owned)
    owners = {r.product_sk: r.owners for r in counts.collect()}
    pairs = baskets.pair_counts(owned, counts=counts)
    got = {(r.item_a, r.item_b): (r.n_together, r.owners_a, r.owners_b) for r in pairs.collect()}
    assert got == {p: (n, owners[p[0]], owners[p[1]]) for p, n in brute_pairs(rows).items()}
    assert dict(pairs.dtypes) == {"item_a": "bigint", "item_b": "bigint", "n_together": "bigint", "owners_a": "bigint", "owners_b": "bigint"}
    plan = pairs._jdf.queryExecution().optimizedPlan().toString()
    assert ("as array<int>" in plan) == (abs(shift) < 1 << 31) and "as array<smallint>" in plan
    assert "rest_owners" not in baskets.pair_counts(owned)._jdf.queryExecution().optimizedPlan().toString()


def test_narrow_type():
    assert baskets.narrow_type("bigint", 0, 127) == "tinyint" and baskets.narrow_type("bigint", -129, 5) == "smallint"
    assert baskets.narrow_type("bigint", 0, 1 << 31) == "bigint" and baskets.narrow_type("bigint", 0, 9, among=("int",)) == "int"
    assert baskets.narrow_type("int", 0, 1 << 20, among=("int",)) == "int" and baskets.narrow_type("string", None, None) == "string"
    assert baskets.narrow_type("bigint", None, None) == "bigint"


@pytest.mark.parametrize("shift", [0, 1 << 40])
def test_descriptions_move_once_for_the_pairs_of_a_task(spark, facts, shift):
    """The same rows as two plain joins, where items have no description or two of them, and pairs move packed in arrays."""
    owned = baskets.ownership(facts.withColumn("product_sk", F.col("product_sk") + shift))
    counts = baskets.owner_counts(owned)
    pairs = baskets.pair_counts(owned, counts=counts)
    named = [(p + shift, f"n{p}") for p in range(11)] + [(3 + shift, "again"), (40 + shift, None)]
    described = spark.createDataFrame(named, "product_sk long, name string")
    names = {}
    for p, n in named:
        names.setdefault(p, []).append(n)
    want = sorted((r.item_a, r.item_b, r.n_together, r.owners_a, r.owners_b, a, b) for r in pairs.collect()
                  for a in names.get(r.item_a, []) for b in names.get(r.item_b, []))
    columns = ["item_a", "item_b", "n_together", "owners_a", "owners_b", "name_a", "name_b"]
    for limit in ("10m", "-1"):
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            out = baskets.described_pairs(pairs, described, ["name"], 40)
            assert sorted(tuple(r) for r in out.select(*columns).collect()) == want
            plan = out._jdf.queryExecution().executedPlan().toString()
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    last = plan[plan.rindex("ShuffledHashJoin [_place"):]
    assert last.count("direct_shuffle_partition_id(_place") == 2 and not re.search(r"Exchange hashpartitioning\([^()]*_place", plan)
