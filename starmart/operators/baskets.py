"""Co-ownership: which products (or categories) the same customers hold.

Distinct ownership comes first, so a customer's group never exceeds the catalogue, however many transactions the
customer has. The items of a customer are cut into chunks; equal chunks are counted as one with a weight. What travels of
a pair is its second item only, in an array with all others that follow one first item; pairs are spread out and counted
where these arrays arrive. Pairs of a first item that many hold are summed before they travel.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starmart.functions.columns import ratio
from starmart.session import broadcastable, staged

#: Items of an owner that are gathered into one array on average; an owner with more has several.
CHUNK_ITEMS = 512
#: Owners from which the pairs of a first item are summed before they travel.
HOT_OWNERS = 10_000
#: Pairs that are counted in one task, in memory.
TASK_PAIRS = 1 << 20
#: Described items that are hashed in one task.
TASK_ITEMS = 1 << 16
#: Cells that pairs are first counted in where a support may drop them; so many rows are broadcast at most.
SKETCH_CELLS = 1 << 20


def ownership(facts: DataFrame, owner: str = "customer_sk", item: str = "product_sk") -> DataFrame:
    """Distinct (owner, item) pairs."""
    return facts.select(owner, item).where(F.col(item).isNotNull()).distinct()


def owner_counts(owned: DataFrame, owner: str = "customer_sk", item: str = "product_sk") -> DataFrame:
    """Owners per item, from distinct ownership."""
    return owned.groupBy(item).agg(F.count(owner).alias("owners"))


def baskets_by_owner(owned: DataFrame, owner: str = "customer_sk", item: str = "product_sk") -> DataFrame:
    """Sorted item array per owner. The input is distinct, so the array is bounded by the catalogue."""
    return owned.groupBy(owner).agg(F.sort_array(F.collect_list(item)).alias("basket"))


def chunks_sql(owned: str, owner: str, item: str, chunk_items: int = CHUNK_ITEMS) -> str:
    """SQL of (owner, chunks, chunk, basket): the items of each owner as sorted arrays of about ``chunk_items``, dealt by hash.

    An owner gets as many chunks as its size asks for; most have one.
    """
    return f"""SELECT {owner}, chunks, chunk, sort_array(collect_list({item})) AS basket
        FROM (SELECT {owner}, {item}, chunks, pmod(xxhash64({item}), chunks) AS chunk
            FROM {owned} JOIN (SELECT {owner}, CAST(ceil(count(*) / {int(chunk_items)}) AS BIGINT) AS chunks FROM {owned} GROUP BY {owner}) USING ({owner}))
        GROUP BY {owner}, chunks, chunk"""


def pair_rows_sql(owned: str, owner: str, item: str, chunk_items: int = CHUNK_ITEMS) -> str:
    """SQL of (item_a, item_b, holders), ``item_a < item_b``: rows that add up to the owners of each pair.

    Pairs inside a chunk come once per distinct chunk, weighted by its holders. Pairs across two chunks are tasks of their
    own, dealt by owner and both chunks, so the pairs of one owner spread over as many tasks as it has pairs of chunks.
    """
    chunks = chunks_sql(owned, owner, item, chunk_items)
    return f"""WITH whole AS (SELECT basket, count(*) AS holders FROM ({chunks}) GROUP BY basket),
    placed AS (SELECT posexplode(basket) AS (place, one), basket, holders FROM whole),
    parts AS (SELECT * FROM ({chunks}) WHERE chunks > 1),
    lower AS (SELECT {owner}, chunk AS lo, explode(sequence(chunk + 1, chunks - 1)) AS hi, basket AS here FROM parts WHERE chunk < chunks - 1),
    upper AS (SELECT {owner}, explode(sequence(0L, chunk - 1)) AS lo, chunk AS hi, basket AS there FROM parts WHERE chunk > 0),
    met AS (SELECT explode(here) AS one, there FROM lower JOIN upper USING ({owner}, lo, hi)),
    across AS (SELECT one, explode(there) AS other FROM met)
    SELECT one AS item_a, explode(slice(basket, place + 2, greatest(size(basket) - place - 1, 0))) AS item_b, holders FROM placed
    UNION ALL SELECT least(one, other), greatest(one, other), 1L FROM across"""


def pair_counts_sql(owned: str, owner: str, item: str, chunk_items: int = CHUNK_ITEMS) -> str:
    """SQL of (item_a, item_b, n_together): the owners that hold both items of a pair."""
    rows = pair_rows_sql(owned, owner, item, chunk_items)
    return f"SELECT item_a, item_b, sum(holders) AS n_together FROM ({rows}) GROUP BY item_a, item_b"


def pairs_by_first_sql(chunked: str, owner: str, tasks: int, item_type: str, owners_type: str, with_owners: bool = True) -> str:
    """SQL of (item_a, item_b, n_together, owners_a, owners_b) from stored chunks of (item, owners), partitioned by ``item_a``.

    An array of the items that follow travels for each first item, of a chunk or of two chunks of an owner. Pairs inside a
    chunk of a first item with :data:`HOT_OWNERS` or more are summed on the map side before that. In the arrays items and owners
    have the given types, which must hold all of them; without ``with_owners`` the owners stay behind.
    """
    def items(structs: str) -> str:
        return f"CAST({structs}.item AS ARRAY<{item_type}>)"

    def counts(structs: str) -> str:
        return f"CAST({structs}.owners AS ARRAY<{owners_type}>)"

    def one(name: str, value: str) -> str:
        return f", {value} AS {name}" if with_owners else ""

    known = ", owners_a, rest_owners" if with_owners else ""
    tail = "place + 2, size(items) - place - 1"
    return f"""WITH whole AS (SELECT basket, count(*) AS holders FROM {chunked} GROUP BY basket),
    placed AS (SELECT posexplode(basket) AS (place, one), {items('basket')} AS items{one('counts', counts('basket'))}, holders FROM whole),
    rests AS (SELECT one, slice(items, {tail}) AS rest{one('rest_owners', f'slice(counts, {tail})')}, holders
        FROM placed WHERE place < size(items) - 1),
    spread AS (SELECT one, posexplode(rest) AS (place, item_b){', rest_owners' if with_owners else ''}, holders FROM rests WHERE one.owners >= {HOT_OWNERS}),
    summed AS (SELECT one.item AS item_a, array(item_b) AS rest, sum(holders) AS holders{one('owners_a', 'one.owners')}{one('rest_owners', 'array(max(rest_owners[place]))')}
        FROM spread GROUP BY one, item_b),
    parts AS (SELECT * FROM {chunked} WHERE chunks > 1),
    lower AS (SELECT {owner}, chunk AS lo, explode(sequence(chunk + 1, chunks - 1)) AS hi, basket AS here FROM parts WHERE chunk < chunks - 1),
    upper AS (SELECT {owner}, explode(sequence(0L, chunk - 1)) AS lo, chunk AS hi, basket AS there FROM parts WHERE chunk > 0),
    met AS (SELECT inline(array(struct(here AS mine, there AS others), struct(there AS mine, here AS others))) FROM lower JOIN upper USING ({owner}, lo, hi)),
    across AS (SELECT one, filter(others, other -> other.item > one.item) AS others FROM (SELECT explode(mine) AS one, others FROM met)),
    dealt AS (SELECT /*+ REPARTITION({int(tasks)}, item_a) */ item_a, rest, holders{known} FROM (
        SELECT one.item AS item_a, rest, holders{one('owners_a', 'one.owners')}{', rest_owners' if with_owners else ''} FROM rests WHERE one.owners < {HOT_OWNERS}
        UNION ALL SELECT item_a, rest, holders{known} FROM summed
        UNION ALL SELECT one.item, {items('others')}, 1L{one('owners_a', 'one.owners')}{one('rest_owners', counts('others'))} FROM across WHERE size(others) > 0)),
    pairs AS (SELECT item_a, posexplode(rest) AS (place, item_b), holders{known} FROM dealt)
    SELECT item_a, item_b, sum(holders) AS n_together{one('owners_a', 'max(owners_a)')}{one('owners_b', 'CAST(max(rest_owners[place]) AS BIGINT)')} FROM pairs GROUP BY item_a, item_b"""


def narrow_type(kind: str, least: int | None, most: int | None, among: Sequence[str] = ("tinyint", "smallint", "int")) -> str:
    """The first of some integer types that holds all values from ``least`` to ``most``, else ``kind``."""
    bits = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}
    if least is None or kind not in bits:
        return kind
    return next((t for t in among if bits[t] < bits[kind] and -(1 << bits[t]) <= least and most < 1 << bits[t]), kind)


def chunked_baskets(
    owned: DataFrame, owner: str = "customer_sk", item: str = "product_sk", chunk_items: int = CHUNK_ITEMS
) -> DataFrame:
    """(owner, chunks, chunk, basket) as in :func:`chunks_sql`."""
    return owned.sparkSession.sql(chunks_sql("{owned}", owner, item, chunk_items), owned=owned)


def _pairs(baskets: DataFrame) -> DataFrame:
    """Unordered pairs (item_a < item_b) of each basket. ``slice`` keeps this inside generated code."""
    first = baskets.select("*", F.posexplode("basket").alias("_at", "item_a"))
    rest = F.slice("basket", F.col("_at") + 2, F.greatest(F.size("basket") - F.col("_at") - 1, F.lit(0)))
    return first.withColumn("item_b", F.explode(rest)).drop("_at")


def pair_counts(
    owned: DataFrame, owner: str = "customer_sk", item: str = "product_sk", chunk_items: int = CHUNK_ITEMS,
    counts: DataFrame | None = None,
) -> DataFrame:
    """Owners that hold both items of a pair, ``item_a < item_b``, partitioned by ``item_a``.

    With ``counts``, the owners of each item from :func:`owner_counts`, the pairs carry them as ``owners_a`` and ``owners_b``.
    The chunks are written once; their sizes say how many pairs there are, and so how many tasks count them. They also say how
    many bytes an item and its owners need in the arrays. Without ``counts`` the ownership is written once too.
    """
    if counts is None:
        owned = staged(owned, "owned")
    known = _with_owners(owned, owner_counts(owned, owner, item) if counts is None else counts, owner, item)
    chunked = staged(chunked_baskets(known, owner, "held", chunk_items), "baskets")
    size = F.size("basket").cast("double")
    inside, across = size * (size - 1) / 2, size * (F.col("chunks") - 1) * chunk_items / 2
    kind = dict(owned.dtypes)[item]
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    ends = [F.min(F.element_at("basket", 1)["item"]), F.max(F.element_at("basket", -1)["item"])] if whole else []  # baskets are sorted
    most_owners = F.max(F.array_max(F.transform("basket", lambda held: held["owners"])))
    found, most, *ends = chunked.agg(F.sum(inside + across), most_owners, *ends).first()
    tasks = int(found or 0) // TASK_PAIRS + 1
    if tasks > 1:  # with fewer partitions than other shuffles have, a join by item_a would move the pairs again
        tasks = max(tasks, int(owned.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    item_type = narrow_type(kind, *ends, among=("int",)) if whole else kind
    pairs = owned.sparkSession.sql(
        pairs_by_first_sql("{chunked}", owner, tasks, item_type, narrow_type("bigint", most and 0, most), counts is not None), chunked=chunked)
    return pairs.withColumn("item_b", F.col("item_b").cast(kind))


def _with_owners(owned: DataFrame, counts: DataFrame, owner: str, item: str) -> DataFrame:
    """(owner, held): each item held together with its number of owners."""
    return owned.join(counts.select(F.col(item), F.col("owners")), item).select(
        owner, F.struct(F.col(item).alias("item"), F.col("owners")).alias("held"))


def _bucket(a: str, b: str) -> Column:
    return F.pmod(F.xxhash64(a, b), F.lit(SKETCH_CELLS))


def promising_pairs(
    owned: DataFrame, least_support: float, owner: str = "customer_sk", item: str = "product_sk", chunk_items: int = CHUNK_ITEMS
) -> DataFrame:
    """(item_a, item_b, holders, owners_a, owners_b) like :func:`pair_rows_sql`, without pairs that cannot reach the support.

    Each item travels with its number of owners. All pairs are first summed in :data:`SKETCH_CELLS` cells by hash; a pair's
    cell is at least its count, so a pair whose cell stays below what either support asks for is dropped before the shuffle.
    """
    known = _with_owners(owned, owner_counts(owned, owner, item), owner, item)
    rows = owned.sparkSession.sql(pair_rows_sql("{owned}", owner, "held", chunk_items), owned=known).select(
        F.col("item_a.item").alias("item_a"), F.col("item_b.item").alias("item_b"), "holders",
        F.col("item_a.owners").alias("owners_a"), F.col("item_b.owners").alias("owners_b"))
    cells = rows.groupBy(_bucket("item_a", "item_b").alias("_cell")).agg(F.sum("holders").alias("_most"))
    # at most one row per cell
    met = rows.withColumn("_cell", _bucket("item_a", "item_b")).join(F.broadcast(cells), "_cell")
    needed = F.lit(float(least_support)) * F.least("owners_a", "owners_b") * (1 - 1e-9)
    return met.where(F.col("_most") >= needed).drop("_cell", "_most")


def supported_pairs(
    owned: DataFrame, least_support: float, owner: str = "customer_sk", item: str = "product_sk", chunk_items: int = CHUNK_ITEMS,
    most_owners: int | None = None,
) -> DataFrame:
    """Pairs of which one support reaches ``least_support``, as in :func:`pair_support`.

    Where the support asks for more than one owner of some item, pairs that cannot reach it are dropped before they are
    shuffled; else every pair that exists reaches it and there is nothing to drop. ``most_owners`` of an item are counted if not given.
    """
    counts = owner_counts(owned, owner, item)
    most = counts.agg(F.max("owners")).first()[0] or 0 if most_owners is None else most_owners
    if most * least_support <= 1:
        pairs = pair_support(pair_counts(owned, owner, item, chunk_items, counts), counts, item)
    else:
        pairs = promising_pairs(owned, least_support, owner, item, chunk_items).groupBy("item_a", "item_b", "owners_a", "owners_b").agg(
            F.sum("holders").alias("n_together")).select("item_b", "item_a", "n_together", "owners_a", "owners_b").withColumns({
                "support_a": ratio(F.col("n_together"), F.col("owners_a")), "support_b": ratio(F.col("n_together"), F.col("owners_b"))})
    return pairs.where((F.col("support_a") >= least_support) | (F.col("support_b") >= least_support))


def pair_support(pairs: DataFrame, counts: DataFrame | None = None, item: str = "product_sk") -> DataFrame:
    """Add the share of the owners of each item that hold both; pairs that carry their owners are not joined to ``counts``."""
    shares = {"support_a": ratio(F.col("n_together"), F.col("owners_a")), "support_b": ratio(F.col("n_together"), F.col("owners_b"))}
    if {"owners_a", "owners_b"} <= set(pairs.columns):
        first = ("item_b", "item_a", "n_together", "owners_a", "owners_b")
        return pairs.select(*first, *[c for c in pairs.columns if c not in (*first, *shares)]).withColumns(shares)
    both = pairs.join(counts.select(F.col(item).alias("item_a"), F.col("owners").alias("owners_a")), "item_a").join(
        counts.select(F.col(item).alias("item_b"), F.col("owners").alias("owners_b")), "item_b")
    return both.withColumns(shares)


def described_pairs(pairs: DataFrame, described: DataFrame, columns: Sequence[str], most_owners: int, item: str = "product_sk") -> DataFrame:
    """Pairs that carry their owners, with ``columns`` of ``described`` as ``..._a`` and ``..._b``; only pairs of which both items are described.

    Pairs stay where they are if Spark would broadcast the descriptions. Else they get the first item's where they were counted, and then
    move to the second item's: the pairs of a first item that go to one task are a row, so a description is moved once for them all and of a
    pair only its second item and two counts, in as few bytes as ``most_owners`` and the described items need.
    """
    kind = dict(described.dtypes)[item]

    def side(which: str) -> DataFrame:
        return described.select(F.col(item).alias(f"item_{which}"), *[F.col(c).alias(f"{c}_{which}") for c in columns])

    if broadcastable(described.select(item, *columns)):
        return pairs.join(side("a"), "item_a").join(side("b"), "item_b")
    whole = kind in ("tinyint", "smallint", "int", "bigint") and kind == dict(pairs.dtypes)["item_b"]
    held, *ends = described.agg(F.count(F.lit(1)), *([F.min(item), F.max(item)] if whole else [])).first()
    item_type = narrow_type(kind, *ends, among=("int",)) if whole else dict(pairs.dtypes)["item_b"]
    count_type = narrow_type("bigint", 0, most_owners)
    tasks = max(4 * pairs.sparkSession.sparkContext.defaultParallelism, held // TASK_ITEMS + 1)

    def place(column: str) -> Column:
        return F.pmod(F.xxhash64(F.col(column).cast(kind)), F.lit(tasks)).cast("int").alias("_place")

    packed = pairs.groupBy("item_a", place("item_b")).agg(
        F.max("owners_a").alias("owners_a"),
        # an item beyond the described ones has none and meets nothing
        F.collect_list(F.struct(F.col("item_b").try_cast(item_type).alias("item"), F.col("n_together").cast(count_type).alias("n"), F.col("owners_b").cast(count_type).alias("o"))).alias("_held"),
    ).select("item_a", "_place", "owners_a", F.col("_held.item").alias("_items"), F.col("_held.n").alias("_n"), F.col("_held.o").alias("_o"))
    # dealt to the tasks by number, which the join takes as it is; hashed, so that the pairs, of which there are far more, are not sorted
    dealt = packed.join(side("a").hint("shuffle_hash"), "item_a").repartitionById(tasks, "_place")
    spread = dealt.select("*", F.posexplode("_items").alias("_at", "item_b")).withColumns({
        "item_b": F.col("item_b").cast(kind),
        "n_together": F.col("_n")[F.col("_at")].cast("bigint"),
        "owners_b": F.col("_o")[F.col("_at")].cast("bigint"),
    }).drop("_items", "_n", "_o", "_at")
    second = side("b").withColumn("_place", place("item_b")).repartitionById(tasks, "_place").hint("shuffle_hash")
    return spread.join(second, ["_place", "item_b"]).drop("_place")


def affinity_matrix(
    owned: DataFrame, items: Sequence | None = None, owner: str = "customer_sk", item: str = "product_category"
) -> DataFrame:
    """Share of the owners of ``item_a`` that also own ``item_b``, for every ordered pair that somebody holds.

    The diagonal is 1. With ``items``, the catalogue of the matrix, only these count and pairs nobody holds are 0.
    """
    counts = owner_counts(owned, owner, item)
    half = pair_counts(owned, owner, item)
    diagonal = counts.select(F.col(item).alias("item_a"), F.col(item).alias("item_b"), F.col("owners").alias("n_together"))
    held = half.unionByName(
        half.select(F.col("item_b").alias("item_a"), F.col("item_a").alias("item_b"), "n_together")
    ).unionByName(diagonal)
    owners = counts.select(F.col(item).alias("item_a"), "owners")
    if items is None:
        cells = held.join(owners, "item_a")
    else:
        values = list(items)
        grid = owners.where(F.col("item_a").isin(values)).withColumn("item_b", F.explode(F.array(*[F.lit(v) for v in values])))
        cells = grid.join(held, ["item_a", "item_b"], "left")
    together = F.coalesce("n_together", F.lit(0))
    return cells.select("item_a", "item_b", ratio(together, F.col("owners")).alias("affinity"))


def mean_affinity(
    owned: DataFrame, items: Sequence | None = None, owner: str = "customer_sk", item: str = "product_category"
) -> DataFrame:
    """Mean affinity of each owner over the ordered pairs of two different items owned; 0 for a single item.

    Worked out once per distinct basket and joined back, so owners with equal baskets share the work. With ``items``
    only these count.
    """
    if items is not None:
        owned = owned.where(F.col(item).isin(list(items)))
    counts = owner_counts(owned, owner, item)
    affinity = pair_support(pair_counts(owned, owner, item, counts=counts), counts, item).select(
        "item_a", "item_b", (F.col("support_a") + F.col("support_b")).alias("_both_ways")
    )
    per_owner = baskets_by_owner(owned, owner, item)
    scores = (
        _pairs(per_owner.select("basket").distinct())
        .join(affinity, ["item_a", "item_b"])
        .groupBy("basket")
        .agg((F.sum("_both_ways") / (2 * F.count(F.lit(1)))).alias("_score"))
    )
    return per_owner.join(scores, "basket", "left").select(
        owner, F.coalesce("_score", F.lit(0.0)).alias("avg_affinity")
    )


def pivot_counts(df: DataFrame, by: str, column: str, values: Sequence, prefix: str, counted: str) -> DataFrame:
    """Non-NULL counts of ``counted`` per value, one column each, 0 where there is none."""
    return _pivot(df, by, column, values, prefix, F.count(counted), 0)


def pivot_sums(df: DataFrame, by: str, column: str, values: Sequence, prefix: str, summed: str) -> DataFrame:
    """Sums per value, one column each, 0 where there is none."""
    return _pivot(df, by, column, values, prefix, F.sum(summed), 0)


def ownership_matrix(owned: DataFrame, values: Sequence, owner: str = "customer_sk", item: str = "product_category") -> DataFrame:
    """One 0/1 column per item."""
    return _pivot(owned, owner, item, values, "", F.max(F.lit(1)), 0)


def _pivot(df: DataFrame, by: str, column: str, values: Sequence, prefix: str, measure, fill) -> DataFrame:
    wide = df.groupBy(by).pivot(column, list(values)).agg(measure)
    kinds = {f.name: f.dataType for f in wide.schema.fields}
    return wide.select(
        by,
        *[
            F.coalesce(F.col(f"`{v}`"), F.lit(fill).cast(kinds[str(v)])).alias(name)
            for v, name in zip(values, column_names(prefix, values), strict=True)
        ],
    )


def column_name(prefix: str, value) -> str:
    """Prefix and value as a column name that Parquet and SQL accept unquoted."""
    return prefix + "".join(ch if ch.isalnum() else "_" for ch in str(value))


def column_names(prefix: str, values: Sequence) -> list[str]:
    """A name for each value; names that would be equal, letter case aside, get a number behind them."""
    names, taken = [], set()
    for value in values:
        name = plain = column_name(prefix, value)
        n = 1
        while name.lower() in taken:
            n += 1
            name = f"{plain}_{n}"
        taken.add(name.lower())
        names.append(name)
    return names


def owned_sets(owned: DataFrame, owner: str = "customer_sk", item: str = "product_category") -> DataFrame:
    """The items of each owner as a sorted array."""
    return baskets_by_owner(owned, owner, item).withColumnRenamed("basket", f"{item}_set")
