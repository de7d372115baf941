"""The trie of the turn prefixes that conversations share, from padded matrices of turn ids.

A turn is a 128-bit digest of its role and text. A conversation is cut into bands of 16 turns; a row holds the turns of one
band, and the digest of all turns before it. Rows are range-partitioned by (band, digest before, turns, conversation), so
that the members of a node of the trie are neighbours, whatever shard they lie in.

A shard is one padded matrix of turn ids: sorted by `lexsort`, the masks of changed columns OR-accumulated from the left
mark where nodes start, and `reduceat` sums each depth over its nodes. A shard knows the last row before it and the first
row after it, so that a node starts, and a leaf ends, in exactly one shard; all sums over a subtree are then sums over rows.
Nodes that reach over a shard's edge, or from one band into the next, come out in parts that add up.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from starmart.operators.ordered import with_position

from .staging import carry_modules, parts, staged

#: Turns of a band, the columns of a matrix.
BAND = 16
#: Rows of a shard, the rows of a matrix.
SHARD_ROWS = 32_768
EMPTY = hashlib.sha256(b"").hexdigest()
_MOST = np.iinfo(np.int64).max

DEEP = "conv_id long, band int, leaves long, saved long"
NODES = (
    "shard int, key binary, conv_id long, depth long, parent_conv_id long, parent_key binary, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends binary, ends_sha256 string")
_NODES = pa.schema([
    ("shard", pa.int32()), ("key", pa.binary()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64()),
    ("parent_key", pa.binary()), ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
    ("saved_tokens", pa.int64()), ("ends", pa.binary()), ("ends_sha256", pa.string())])


# --- rows ---------------------------------------------------------------------------------------------------

def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, at, id, size): the place of each turn in its conversation, its digest and the bytes of its text.

    Turns are ordered by number, NULL first; turns of one number by their digest.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    said = F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)
    narrow = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").isNotNull().alias("numbered"),
        F.coalesce(F.col("turn").cast("long"), F.lit(0)).alias("turn"), _half(F.sha2(said, 256)).alias("id"),
        F.octet_length(text).cast("long").alias("size"))
    return with_position(narrow, "conv_id", ["numbered", "turn", "id"], "at").select("conv_id", "at", "id", "size")


def _half(digest: Column) -> Column:
    return F.unhex(F.substring(digest, 1, 32))


def plain_sequences(turns: DataFrame) -> DataFrame:
    """(conv_id, at, id, size, length) of conversations as they are."""
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"))
    return turns.join(lengths, "conv_id")


def rebuilt_sequences(turns: DataFrame, group: int = 5, most: int = 9) -> DataFrame:
    """(conv_id, at, id, size, length) after each conversation c has got the head of another.

    The first h turns are those of conversation c - c % group (all if it has fewer, none if it is not there) and c's own
    follow after its first h; h is crc32(c) % most. `%` keeps the sign, as in SQL. A conversation left without turns has
    one row, whose `at` is NULL.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    heads = (
        turns.where((F.col("conv_id") % group == 0) & (F.col("at") < most - 1)).groupBy(F.col("conv_id").alias("base"))
        .agg(F.sort_array(F.collect_list(F.struct("at", "id", "size"))).alias("head"))
    )
    nothing = F.array().cast("array<struct<at:bigint,id:binary,size:bigint>>")
    convs = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")).withColumn("base", F.col("conv_id") - F.col("conv_id") % group)
    convs = convs.join(heads, "base", "left").withColumn("h", h).withColumn(
        "head", F.slice(F.coalesce("head", nothing), F.lit(1), F.greatest("h", F.lit(0))))
    convs = staged(convs.select(
        "conv_id", "head", (F.size("head") - F.col("h")).alias("shift"),
        (F.size("head") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length")), "rebuilt")
    first = convs.select("conv_id", F.explode_outer("head").alias("t"), "length").where("t IS NOT NULL OR length = 0").select(
        "conv_id", "t.at", "t.id", "t.size", "length")
    own = turns.where(F.col("at") >= h).join(convs.select("conv_id", "shift", "length"), "conv_id").select(
        "conv_id", (F.col("at") + F.col("shift")).alias("at"), "id", "size", "length")
    return first.unionByName(own)


def band_rows(sequences: DataFrame) -> DataFrame:
    """One row for each band of a conversation: conv_id, band, ids, sizes, more, before, after; written.

    `before` is a digest of all bands before, `after` of these and a full band itself; `more` tells whether a band follows.
    The digest adds up 240 bits of each band's own digest, so it needs no pass over a conversation in one piece.
    """
    band = F.floor(F.coalesce("at", F.lit(0)) / BAND).cast("int").alias("band")
    cells = F.sort_array(F.collect_list(F.when(F.col("at").isNotNull(), F.struct("at", "id", "size"))))
    bands = sequences.groupBy("conv_id", band).agg(cells.alias("cells"), F.max("length").alias("length")).select(
        "conv_id", "band", F.col("cells.id").alias("ids"), F.col("cells.size").alias("sizes"), "length")
    bands = staged(bands, "bands")
    none = F.lit(None).cast("binary")
    short = bands.where(F.col("length") < BAND).select("*", F.unhex(F.lit("")).alias("before"), none.alias("after"))
    long = bands.where(F.col("length") >= BAND)
    turns = [F.coalesce(F.get("ids", F.lit(i)), F.unhex(F.lit(""))) for i in range(BAND)]
    own = F.sha2(F.concat(F.concat("band", F.lit(":")).cast("binary"), *turns), 256)
    digests = long.withColumn("own", own)
    bits = [F.conv(F.substring("own", 1 + 15 * i, 15), 16, 10).cast("decimal(38,0)") for i in range(4)]
    until = Window.partitionBy("conv_id").orderBy("band").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    digests = digests.withColumns({f"s{i}": F.sum(b).over(until) for i, b in enumerate(bits)})
    after = [F.col(f"s{i}").cast("string") for i in range(4)]
    before = [(F.col(f"s{i}") - b).cast("string") for i, b in enumerate(bits)]
    long = digests.withColumns({
        "before": F.when(F.col("band") == 0, F.unhex(F.lit(""))).otherwise(_half(F.sha2(F.concat_ws(",", F.col("band").cast("string"), *before), 256))),
        "after": F.when(F.size("ids") == BAND, _half(F.sha2(F.concat_ws(",", (F.col("band") + 1).cast("string"), *after), 256))),
    }).select(*short.columns)
    more = (F.col("length") > (F.col("band") + 1) * BAND).alias("more")
    return staged(short.unionByName(long).select("conv_id", "band", "ids", "sizes", more, "before", "after"), "band-rows")


# --- one shard ----------------------------------------------------------------------------------------------

class Matrix:
    """The rows of a shard as a padded matrix, sorted, with the marks of node starts and leaf ends."""

    def __init__(self, rows: pa.Table, before: dict | None, after: dict | None):
        n = len(rows)
        ids, sizes = rows["ids"].combine_chunks(), rows["sizes"].combine_chunks()
        self.length = np.asarray(ids.value_lengths().fill_null(0), np.int64)
        digests = ids.flatten().to_pylist()
        places = _ranks(digests)
        row = np.repeat(np.arange(n), self.length)
        column = np.arange(len(digests)) - np.repeat(np.cumsum(self.length) - self.length, self.length)
        cells = np.full((n, BAND), -1, np.int64)
        cells[row, column] = places
        size = np.zeros((n, BAND), np.int64)
        size[row, column] = np.asarray(sizes.flatten(), np.int64)
        band = np.asarray(rows["band"], np.int64)
        more = np.asarray(rows["more"].combine_chunks().cast(pa.int8()), bool)
        conv = np.asarray(rows["conv_id"], np.int64)
        prefixes = rows["before"].to_pylist()
        prefix = _ranks(prefixes)
        order = np.lexsort((conv, more, *[cells[:, j] for j in range(BAND - 1, -1, -1)], prefix, band))
        self.cells, self.size, self.length = cells[order], size[order], self.length[order]
        self.band, self.prefix, self.more, self.conv, self.order = band[order], prefix[order], more[order], conv[order], order
        self.rows = rows
        self._ids, self._prefixes, self._starts = digests, prefixes, np.concatenate([[0], np.cumsum(np.asarray(ids.value_lengths().fill_null(0)))])
        self.valid = np.arange(BAND) < self.length[:, None]
        # whether a row's group, and its first j + 1 turns, differ from the row above
        self.new_group = np.ones(n, bool)
        self.new_group[1:] = (self.band[1:] != self.band[:-1]) | (self.prefix[1:] != self.prefix[:-1])
        changed = np.ones((n, BAND), bool)
        changed[1:] = np.logical_or.accumulate(self.cells[1:] != self.cells[:-1], axis=1) | self.new_group[1:, None]
        self.changed = changed
        self.shared_before, self.shared_after = self._shared(0, before), self._shared(n - 1, after)
        self.starts = changed & self.valid
        if self.shared_before >= 0:
            self.starts[0, : self.shared_before] = False
        # how many of a row's turns the row below has too, -1 in another group
        below = np.empty(n, np.int64)
        below[:-1] = np.where(self.new_group[1:], -1, BAND - changed[1:].sum(axis=1))
        below[-1] = self.shared_after
        self.leaf = ~self.more & (below < self.length)

    def _shared(self, i: int, other: dict | None) -> int:
        """How many leading turns row i shares with another shard's row; -1 in another group."""
        if other is None or other["band"] != self.band[i] or other["before"] != self._prefixes[self.order[i]]:
            return -1
        own, shared = self.ids(i), 0
        while shared < min(len(own), len(other["ids"])) and own[shared] == other["ids"][shared]:
            shared += 1
        return shared

    def ids(self, i: int) -> list[bytes]:
        at = self.order[i]
        return self._ids[self._starts[at]: self._starts[at + 1]]

    def key(self, i: int, depth: int) -> bytes:
        """Name of the node of row i's first `depth` turns in its band; a full band is the next one's start."""
        at = int(self.order[i])
        if depth == BAND:
            return hashlib.sha256(b"%d:" % (self.band[i] + 1) + self.rows["after"][at].as_py()).digest()
        return hashlib.sha256(b"%d:" % self.band[i] + self._prefixes[at] + b"".join(self.ids(i)[:depth])).digest()

    def spared(self) -> np.ndarray:
        """Bytes of each cell that an earlier member of the same node holds already."""
        return np.where(self.valid & ~self.starts, self.size, 0)


def _ranks(values: list[bytes]) -> np.ndarray:
    """The place of each value among the distinct ones in byte order."""
    known = {v: i for i, v in enumerate(sorted(set(values)))}
    return np.fromiter((known[v] for v in values), np.int64, len(values))


def _edges(notes: pa.Table) -> tuple[dict | None, dict | None]:
    for r in notes.select(["left", "right", "edge"]).to_pylist():
        if r["edge"]:
            return r["left"], r["right"]
    return None, None


def _deep(rows: pa.Table, notes: pa.Table) -> pa.Table:
    if not len(rows):
        return pa.Table.from_pydict({"conv_id": [], "band": [], "leaves": [], "saved": []}, _DEEP)
    m = Matrix(rows, *_edges(notes))
    return pa.Table.from_arrays([
        pa.array(m.conv), pa.array(m.band.astype(np.int32)), pa.array(m.leaf.astype(np.int64)), pa.array(m.spared().sum(axis=1))], schema=_DEEP)


_DEEP = pa.schema([("conv_id", pa.int64()), ("band", pa.int32()), ("leaves", pa.int64()), ("saved", pa.int64())])


def _nodes(rows: pa.Table, notes: pa.Table) -> pa.Table:
    """The nodes of one shard; those that reach beyond it have a key and are parts."""
    if not len(rows):
        return _NODES.empty_table()
    m = Matrix(rows, *_edges(notes))
    n, shard = len(rows), rows["shard"][0].as_py()
    known = notes.filter(pc.invert(notes["edge"]))
    below = {(c, b): (x, s) for c, b, x, s in zip(*(known[k].to_pylist() for k in ("conv_id", "band", "leaves", "saved")), strict=True)}
    leaves, saved = m.leaf.astype(np.int64), np.zeros(n, np.int64)
    if below:
        for i in np.flatnonzero(m.more).tolist():
            more, spare = below.get((int(m.conv[i]), int(m.band[i])), (0, 0))
            leaves[i] += more
            saved[i] += spare
    # what is spared from each column on, with all bands that follow
    spared = m.spared()
    suffix = np.zeros((n, BAND + 1), np.int64)
    suffix[:, :BAND] = np.cumsum(spared[:, ::-1], axis=1)[:, ::-1]
    suffix += saved[:, None]
    out: list[pa.Table] = []
    parent_of = parent_min = parent_key = None  # of each row's node one level up: its number, and by number its smallest member and key
    for depth in range(BAND + 1):
        member = m.length >= depth if depth else np.ones(n, bool)
        opens = (m.changed[:, depth - 1] & m.valid[:, depth - 1]) if depth else m.new_group.copy()
        opens[0] = member[0]
        at = np.flatnonzero(opens)
        if not len(at):
            break
        total = lambda values: np.add.reduceat(np.where(member, values, 0), at)
        number = np.cumsum(opens) - 1
        own_band = m.band[at]
        ending = member & (m.length == depth) & ~m.more
        n_convs, n_ends = total(np.ones(n, np.int64)), total(ending)
        smallest = np.minimum.reduceat(np.where(member, m.conv, _MOST), at)
        children = total(m.starts[:, depth]) if depth < BAND else np.zeros(len(at), np.int64)
        n_leaves, n_saved = total(leaves), total(suffix[:, max(depth - 1, 0)])
        part = np.zeros(len(at), bool)
        if at[0] == 0 and m.shared_before >= depth:
            part[0] = True
        if member[-1] and m.shared_after >= depth:
            part[-1] = True
        if depth == BAND:
            part |= total(m.more) > 0
        head = np.zeros(len(at), bool)
        if depth == 0:
            head = own_band > 0  # the start of a band is a node of the band above; only its children are counted here
            part |= head
        keys = [m.key(int(i), depth) if p else None for i, p in zip(at, part, strict=True)]
        zero = lambda values: np.where(head, 0, values)
        ends, digests = [], []
        for i, e, p, h in zip(at.tolist(), n_ends.tolist(), part.tolist(), head.tolist(), strict=True):
            mine = m.conv[i: i + e] if not h else m.conv[:0]
            ends.append(mine.astype("<i8").tobytes() if p else None)
            digests.append(None if p else EMPTY if not e else hashlib.sha256(",".join(map(str, mine.tolist())).encode()).hexdigest())
        if depth:
            up = parent_of[at]
            parent = [None if parent_key[u] is not None else int(parent_min[u]) for u in up]
            above = [parent_key[u] for u in up]
        else:
            parent = above = [None] * len(at)
        out.append(pa.Table.from_arrays([
            pa.array([shard] * len(at), pa.int32()), pa.array(keys, pa.binary()), pa.array(smallest, pa.int64(), mask=head),
            pa.array(own_band * BAND + depth), pa.array(parent, pa.int64()), pa.array(above, pa.binary()), pa.array(zero(n_convs)),
            pa.array(children), pa.array(zero(n_leaves)), pa.array(zero(n_saved)), pa.array(ends, pa.binary()), pa.array(digests, pa.string())],
            schema=_NODES))
        parent_of, parent_min, parent_key = number, smallest, keys
    return pa.concat_tables(out)


# --- all shards ---------------------------------------------------------------------------------------------

def trie(sequences: DataFrame, *, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every node.

    `sequences` are the turns (conv_id, at, id, size, length) with `at` counted from 0. The smallest member names a node at
    its depth. The digest of the ids that end at a node is worked out in one stream, in order and without gathering them.
    """
    rows = band_rows(sequences)
    shards = max(parts(rows.count(), shard_rows), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    placed = rows.repartitionByRange(shards, "band", "before", "ids", "more", "conv_id").withColumn("shard", F.spark_partition_id())
    placed = staged(placed, "trie-shards")
    place = F.struct("band", "before", "ids")
    along = Window.orderBy("shard")  # over one row a shard
    edges = placed.groupBy("shard").agg(F.min(place).alias("first"), F.max(place).alias("last")).select(
        "shard", F.lag("last").over(along).alias("left"), F.lead("first").over(along).alias("right"), F.lit(True).alias("edge"))
    edges = staged(edges, "trie-edges")
    grouped = placed.groupBy("shard")
    deep = placed.where("band > 0").groupBy("shard").cogroup(edges.groupBy("shard")).applyInArrow(lambda a, b: _deep(a, b), DEEP)
    from_here = Window.partitionBy("conv_id").orderBy(F.col("band").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    under = deep.select("conv_id", (F.col("band") - 1).alias("band"), F.sum("leaves").over(from_here).alias("leaves"), F.sum("saved").over(from_here).alias("saved"))
    told = placed.where("more").select("shard", "conv_id", "band").join(under, ["conv_id", "band"]).withColumn("edge", F.lit(False))
    notes = edges.unionByName(told, allowMissingColumns=True)
    found = staged(grouped.cogroup(notes.groupBy("shard")).applyInArrow(lambda a, b: _nodes(a, b), NODES), "trie-nodes")

    pieces = found.where("key IS NOT NULL")
    up = F.when(F.col("n_convs") > 0, F.struct("shard", "parent_key", "parent_conv_id"))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = staged(pieces.groupBy("key").agg(F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.min(up).alias("up"), *sums), "trie-merged")
    whole = merged.join(_ends(pieces), "key", "left").select(
        "up.shard", "conv_id", "depth", "up.parent_conv_id", "up.parent_key", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(EMPTY)).alias("ends_sha256"))
    nodes = found.where("key IS NULL").select(*whole.columns).unionByName(whole)
    # a shard asks only for the parents that it holds a part of
    named = pieces.select("shard", F.col("key").alias("parent_key")).distinct().join(
        merged.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("above")), "parent_key")
    return nodes.join(named, ["shard", "parent_key"], "left").select(
        "conv_id", "depth", F.coalesce("parent_conv_id", "above").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        "saved_tokens", "ends_sha256")


def _ends(pieces: DataFrame) -> DataFrame:
    """(key, ends_sha256): the ids of a node's pieces, in the order of the shards, streamed through a digest."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.binary()), pa.array([r[1] for r in rows], pa.string())], names=["key", "ends_sha256"])

        key, digest, done = None, None, []
        for batch in batches:
            for k, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                line = ",".join(map(str, np.frombuffer(ids, "<i8").tolist())).encode()
                if k != key:
                    if key is not None:
                        done.append((key, digest.hexdigest()))
                    key, digest = k, hashlib.sha256(line)
                else:
                    digest.update(b"," + line)
            if len(done) >= 1000:
                yield table(done)
                done = []
        if key is not None:
            yield table([*done, (key, digest.hexdigest())])

    held = pieces.where(F.octet_length("ends") > 0).select("key", "ends", "shard")
    return held.repartition("key").sortWithinPartitions("key", "shard").select("key", "ends").mapInArrow(run, "key binary, ends_sha256 string")


def prefix_trie(conversations: DataFrame, *, group: int | None = None, most: int = 9, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes of the trie of `conversations` (conv_id, turn, role, text; other columns are left out).

    Turns are ordered by number, NULL first, and turns of one number by a digest, so repeated rows are turns of their own.
    A NULL role or text is empty; rows without a conv_id are left out; an empty table has no nodes, not even a root. With
    `group` conversations are rebuilt first, see :func:`rebuilt_sequences`.
    """
    carry_modules(conversations.sparkSession)
    turns = staged(turn_rows(conversations), "turns")
    return trie(rebuilt_sequences(turns, group, most) if group else plain_sequences(turns), shard_rows=shard_rows)
