"""Prefix trie of conversations, its subtrees summed along an Euler tour.

A conversation is a sequence of turns; each distinct sequence of its first d turns is a node
at depth d. A node is named by two running 64-bit hashes, which exclusive-or adds up from
any split of a conversation. Every node has an enter and an exit arc; sorting parents
together with their children gives each arc the next one of the tour. The tour is ranked as
a linked list: in every round the arcs of locally smallest hash (a third of them, no two
adjacent) are spliced out into the arc before them, until a bounded number is left; their
positions are given back in reverse. Prefix sums over positions, taken at a node's two arcs,
then differ by the sums over its subtree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import partitions, staged, table

#: Turns of a conversation, or positions of the tour, that one window sorts.
BLOCK = 1 << 12
#: Arcs that are ranked in one task.
LAST_ARCS = 1 << 15
#: Members of a node that are joined to one string before the node's digest is taken.
CHUNK_IDS = 512
#: Conversations of as many consecutive ids share the first turns of the lowest.
FAMILY = 100
#: Turns shared at most, and one more.
MOST_SHARED = 6


def _before(*part: str) -> Window:
    return Window.partitionBy(*part).rowsBetween(Window.unboundedPreceding, -1)


def ranged(df: DataFrame, order: list, name: str) -> DataFrame:
    """``df`` sorted into ranges of ``order`` (column ``_range``), staged."""
    spark = df.sparkSession
    return staged(df.repartitionByRange(partitions(spark), *order)
                  .withColumn("_range", F.spark_partition_id()), name)


def hashed_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, seq from 0, h1, h2, chars) of every row, each conversation in order of turn,
    null first; equal turns are in order of a hash of role and text. A null role or text is
    empty; rows without a conv_id take no part."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    turns = staged(conversations.filter(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn",
        *[F.xxhash64(F.lit(i), role, text).alias(f"h{i}") for i in (1, 2)],
        F.char_length(text).cast("long").alias("chars")), "turns")
    order = [F.col("turn").asc_nulls_first(), F.col("h1"), F.col("h2")]
    sorted_ = ranged(turns, [F.col("conv_id"), *order], "sorted-turns")
    earlier = _before("conv_id").orderBy("_range")
    # only a conversation that began in an earlier range: at most one of each range
    begun = sorted_.groupBy("_range", "conv_id").agg(F.count(F.lit(1)).alias("n")) \
        .select("_range", "conv_id", F.sum("n").over(earlier).alias("_begun")) \
        .filter("_begun is not null")
    place = F.row_number().over(Window.partitionBy("_range", "conv_id").orderBy(*order))
    return sorted_.withColumn("_place", place) \
        .join(F.broadcast(begun), ["_range", "conv_id"], "left") \
        .select("conv_id", (F.col("_place") - 1 + F.coalesce("_begun", F.lit(0)))
                .cast("long").alias("seq"), "h1", "h2", "chars")


def share_first_turns(turns: DataFrame) -> DataFrame:
    """Each conversation's first h turns replaced by those of its family's lowest id, with
    h the CRC-32 of its decimal id, modulo MOST_SHARED. Places without a turn stay open."""
    kept = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(MOST_SHARED))
    first = turns.filter(F.col("seq") < MOST_SHARED - 1) \
        .withColumnRenamed("conv_id", "_lowest").filter(F.col("_lowest") % FAMILY == 0)
    heads = turns.filter("seq = 0").select(
        "conv_id", (F.col("conv_id") - F.col("conv_id") % FAMILY).alias("_lowest"),
        kept.alias("_kept"))
    # a lowest id meets at most the ids of its family
    shared = heads.join(first, "_lowest").filter("seq < _kept").select(turns.columns)
    return shared.unionByName(turns.filter(F.col("seq") >= kept))


def prefix_keys(turns: DataFrame) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, chars): the names of every prefix and of the one
    before it. Turns are numbered anew; a long conversation is worked on in blocks."""
    blocks = turns.withColumn("_block", F.expr(f"seq div {BLOCK}"))
    earlier = _before("conv_id").orderBy("_block")
    inside = Window.partitionBy("conv_id", "_block").orderBy("seq")
    running = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    def later_blocks(df: DataFrame, **sums: Column) -> DataFrame:
        """What came before a block; of first blocks nothing."""
        own = df.groupBy("conv_id", "_block").agg(*[c.alias(k) for k, c in sums.items()])
        again = {k: F.sum if k == "n" else F.bit_xor for k in sums}
        return own.select("conv_id", "_block", *[again[k](k).over(earlier).alias(f"_{k}")
                                                 for k in sums]).filter("_block > 0")

    counted = later_blocks(blocks, n=F.count(F.lit(1)))
    keys = ["conv_id", "_block"]
    numbered = blocks.withColumn("_place", F.row_number().over(inside)) \
        .join(counted, keys, "left") \
        .withColumn("depth", (F.col("_place") + F.coalesce("_n", F.lit(0))).cast("long"))
    own = [F.xxhash64("depth", h) for h in ("h1", "h2")]
    summed = staged(numbered.select(
        *keys, "seq", "depth", "chars", own[0].alias("g1"), own[1].alias("g2"))
        .select("*", *[F.bit_xor(f"g{i}").over(running).alias(f"x{i}") for i in (1, 2)]),
        "prefix-sums")
    whole = later_blocks(summed, g1=F.bit_xor("g1"), g2=F.bit_xor("g2"))
    zero = F.lit(0).cast("long")
    named = [F.col(f"x{i}").bitwiseXOR(F.coalesce(f"_g{i}", zero)).alias(f"k{i}")
             for i in (1, 2)]
    joined = summed.join(whole, keys, "left") \
        .select("conv_id", "depth", *named, "g1", "g2", "chars")
    return staged(joined.select(
        "conv_id", "depth", "k1", "k2", "chars",
        *[F.col(f"k{i}").bitwiseXOR(F.col(f"g{i}")).alias(f"p{i}") for i in (1, 2)]),
        "prefixes")


def trie_nodes(prefixes: DataFrame, ids: DataFrame) -> DataFrame:
    """One row a node: depth, k1, k2, p1, p2, conv_id (smallest member), n_convs, chars."""
    nodes = prefixes.groupBy("depth", "k1", "k2").agg(
        F.min("p1").alias("p1"), F.min("p2").alias("p2"), F.min("conv_id").alias("conv_id"),
        F.count(F.lit(1)).alias("n_convs"), F.min("chars").alias("chars"))
    zeros = [F.lit(0).cast("long").alias(c) for c in ("depth", "k1", "k2", "p1", "p2")]
    root = ids.agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_convs")) \
        .filter("n_convs > 0").select(*zeros, "conv_id", "n_convs",
                                      F.lit(0).cast("long").alias("chars"))
    return staged(nodes.unionByName(root), "nodes")


def tour_places(nodes: DataFrame) -> DataFrame:
    """Each node with its place among all parents and all children, sorted by family, and
    what follows there: conv_id, depth, n_convs, chars, up (place as a parent), down (place
    as a child), has_child, has_next, parent (the parent's ``up``), parent_conv_id."""
    as_parent = nodes.select("depth", "k1", "k2", F.lit(0).alias("kind"), "conv_id",
                             F.lit(None).cast("long").alias("n_convs"),
                             F.lit(None).cast("long").alias("chars"))
    as_child = nodes.select((F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"),
                            F.col("p2").alias("k2"), F.lit(1).alias("kind"), "conv_id",
                            "n_convs", "chars")
    order = ["depth", "k1", "k2", "kind", "conv_id"]
    rows = ranged(as_parent.unionByName(as_child), order, "families")
    sorted_ = Window.partitionBy("_range").orderBy(*order)
    number = F.row_number().over(sorted_).cast("long").alias("_n")
    head = F.struct(number, F.col("conv_id").alias("_conv"))
    local = staged(rows.select(
        "_range", "depth", "kind", "conv_id", "n_convs", "chars", number,
        F.lead("kind").over(sorted_).alias("_next"), head.alias("_own"))
        .withColumn("_head", F.last(F.when(F.col("kind") == 0, F.col("_own")), True)
                    .over(Window.partitionBy("_range").orderBy("_n")
                          .rowsBetween(Window.unboundedPreceding, Window.currentRow))),
        "families-in-ranges")
    ends = local.groupBy("_range").agg(
        F.count(F.lit(1)).alias("rows"),
        F.max(F.when(F.col("_n") == 1, F.col("kind"))).alias("first"),
        F.max("_head").alias("last"))
    by_range = Window.orderBy("_range")
    before = by_range.rowsBetween(Window.unboundedPreceding, -1)
    # one row a range: as many as there are shuffle partitions
    ends = ends.withColumn("_offset", F.coalesce(F.sum("rows").over(before), F.lit(0))) \
        .select("_range", "_offset", F.lead("first").over(by_range).alias("_following"),
                F.last(F.when(F.col("last").isNotNull(), F.struct(
                    (F.col("last._n") + F.col("_offset")).alias("_n"),
                    F.col("last._conv").alias("_conv"))), True).over(before).alias("_carried"))
    place = F.col("_n") + F.col("_offset")
    child_follows = F.coalesce("_next", "_following", F.lit(0)) == 1
    found = local.join(F.broadcast(ends), "_range").select(
        "kind", "conv_id", "depth", "n_convs", "chars", place.alias("place"),
        child_follows.alias("follows"),
        F.coalesce(F.col("_head._n") + F.col("_offset"), F.col("_carried._n")).alias("parent"),
        F.coalesce("_head._conv", "_carried._conv").alias("parent_conv_id"))
    up = found.filter("kind = 0").select("conv_id", "depth", F.col("place").alias("up"),
                                         F.col("follows").alias("has_child"))
    down = found.filter("kind = 1").select(
        "conv_id", (F.col("depth") + 1).alias("depth"), "n_convs", "chars",
        F.col("place").alias("down"), F.col("follows").alias("has_next"), "parent",
        "parent_conv_id")
    return staged(up.join(down, ["conv_id", "depth"]), "tour-places")


def tour_arcs(places: DataFrame) -> DataFrame:
    """(id, next, conv_id, depth, enter): a node's enter arc is 2 * down, its exit arc
    2 * up + 1; the last arc, the root's exit, has no next."""
    enter, leave = F.col("down") * 2, F.col("up") * 2 + 1
    after_enter = F.when(F.col("has_child"), (F.col("up") + 1) * 2).otherwise(leave)
    after_exit = F.when(F.col("has_next"), (F.col("down") + 1) * 2) \
        .otherwise(F.col("parent") * 2 + 1)
    arcs = F.array(
        F.struct(enter.alias("id"), after_enter.alias("next"), F.lit(True).alias("enter")),
        F.struct(leave.alias("id"), after_exit.alias("next"), F.lit(False).alias("enter")))
    return places.select("conv_id", "depth", "n_convs", "chars", "has_child",
                         F.inline(arcs))


def _rank_rest(batches: Iterator[pa.RecordBatch]):
    """Positions of the arcs of this one partition, which holds at most LAST_ARCS."""
    ids, after, length = [], {}, {}
    for batch in batches:
        ids += batch.column("id").to_pylist()
        after.update(zip(batch.column("id").to_pylist(), batch.column("next").to_pylist(),
                         strict=True))
        length.update(zip(batch.column("id").to_pylist(), batch.column("n").to_pylist(),
                          strict=True))
    if not ids:
        return
    position = {}
    for head in set(ids) - set(after.values()):
        at, arc = 0, head
        while arc is not None:
            position[arc] = at
            at, arc = at + length[arc], after[arc]
    yield pa.RecordBatch.from_arrays(
        [pa.array(ids, pa.int64()), pa.array([position[i] for i in ids], pa.int64())],
        names=["id", "position"])


def list_rank(arcs: DataFrame, last_arcs: int = LAST_ARCS) -> DataFrame:
    """(id, next) -> (id, position): how many arcs come before each in its list. Lists must
    end (next is null); no two arcs have the same next."""
    rest = staged(arcs.select("id", "next", F.lit(1).cast("long").alias("n")), "arcs")
    rounds: list[DataFrame] = []
    while rest.count() > last_arcs:
        seed = F.lit(len(rounds))
        own, following = F.xxhash64("id", seed), F.xxhash64("next", seed)
        small = F.col("next").isNull() | (own < following) \
            | ((own == following) & (F.col("id") < F.col("next")))
        # what is spliced out is smaller than the arc before it and the one behind it
        taken = rest.filter(small).select(F.col("id").alias("gone"), F.col("next").alias("_next"),
                                          F.col("n").alias("_n"))
        keeps = rest.filter(~small)
        joined = keeps.join(taken, keeps["next"] == taken["gone"], "full")
        both = F.col("id").isNotNull() & F.col("gone").isNotNull()
        spliced = staged(joined.select(
            F.coalesce("id", "gone").alias("id"),
            F.when(F.col("gone").isNotNull(), F.col("_next")).otherwise(F.col("next"))
            .alias("next"),
            (F.coalesce("n", F.lit(0)) + F.coalesce("_n", F.lit(0))).alias("n"),
            F.when(both, F.col("gone")).alias("gone"),
            F.when(both, F.col("n")).alias("ahead")), "spliced-arcs")
        rounds.append(spliced.filter("gone is not null").select("id", "gone", "ahead"))
        rest = spliced.select("id", "next", "n")
    ranked = rest.repartition(1).mapInArrow(_rank_rest, "id long, position long")
    for spliced in reversed(rounds):
        back = F.when(F.col("gone").isNotNull(), F.array(
            F.struct("id", "position"),
            F.struct(F.col("gone").alias("id"),
                     (F.col("position") + F.col("ahead")).alias("position")))) \
            .otherwise(F.array(F.struct("id", "position")))
        ranked = staged(ranked.join(spliced, "id", "left").select(F.inline(back)), "ranked-arcs")
    return ranked


def subtree_sums(places: DataFrame, last_arcs: int = LAST_ARCS) -> DataFrame:
    """(conv_id, depth, n_leaves, saved_tokens) of every node."""
    arcs = staged(tour_arcs(places), "tour")
    leaf = F.when(F.col("enter") & ~F.col("has_child"), 1).otherwise(0).cast("long")
    saved = F.when(F.col("enter"), (F.col("n_convs") - 1) * F.col("chars")).otherwise(0)
    weighed = arcs.select("id", "conv_id", "depth", "enter", leaf.alias("leaf"),
                          saved.alias("saved")) \
        .join(list_rank(arcs, last_arcs), "id") \
        .withColumn("_block", F.expr(f"position div {BLOCK}"))
    inside = Window.partitionBy("_block").orderBy("position") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    sums = staged(weighed.select(
        "_block", "conv_id", "depth", "enter", "leaf", "saved",
        *[F.sum(c).over(inside).alias(f"_{c}") for c in ("leaf", "saved")]), "tour-sums")
    # one row for each BLOCK arcs
    totals = sums.groupBy("_block").agg(F.sum("leaf").alias("leaf"), F.sum("saved").alias("saved"))
    before = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_block", *[F.coalesce(F.sum(c).over(before), F.lit(0))
                                        .alias(f"_before_{c}") for c in ("leaf", "saved")])
    at = sums.join(offsets, "_block")

    def over_subtree(c: str) -> Column:
        through = F.col(f"_{c}") + F.col(f"_before_{c}")
        return F.sum(F.when(F.col("enter"), F.col(c) - through).otherwise(through))

    return at.groupBy("conv_id", "depth").agg(over_subtree("leaf").alias("n_leaves"),
                                              over_subtree("saved").alias("saved_tokens"))


_KEY = ["depth", "k1", "k2"]
_CHUNKS = "depth long, k1 long, k2 long, first long, ids string"
_DIGESTS = "depth long, k1 long, k2 long, digest string"


def _joined_ids(batches: Iterator[pa.RecordBatch]):
    """Runs of at most CHUNK_IDS sorted members of one node, comma-joined."""
    key, ids, out = None, [], []

    def chunk():
        return (*key, ids[0], ",".join(map(str, ids)))

    def batch_of(rows):
        kinds = [pa.int64()] * 4 + [pa.string()]
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
            names=[*_KEY, "first", "ids"])

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*_KEY, "conv_id")]
        for *here, conv_id in zip(*columns, strict=True):
            if ids and (here != key or len(ids) == CHUNK_IDS):
                out.append(chunk())
                ids = []
            key = here
            ids.append(conv_id)
            if len(out) == 1024:
                yield batch_of(out)
                out = []
    if ids:
        out.append(chunk())
    if out:
        yield batch_of(out)


def _digested(batches: Iterator[pa.RecordBatch]):
    """SHA-256 of each node's joined members, read as a stream of sorted chunks."""
    key, state = None, None
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in (*_KEY, "ids")]
        out = []
        for *here, ids in zip(*columns, strict=True):
            if here != key:
                if state is not None:
                    out.append((*key, state.hexdigest()))
                key, state = here, hashlib.sha256(ids.encode())
            else:
                state.update(b"," + ids.encode())
        if out:
            yield _digest_batch(out)
    if state is not None:
        yield _digest_batch([(*key, state.hexdigest())])


def _digest_batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 3 + [pa.string()]
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
        names=[*_KEY, "digest"])


def end_digests(ends: DataFrame) -> DataFrame:
    """(depth, k1, k2, conv_id) of conversations that end at a node -> digest of the ids,
    ascending, comma-joined. A node's ids are joined to chunks in many ranges first."""
    parts = partitions(ends.sparkSession)
    order = [*_KEY, "conv_id"]
    chunks = ends.select(order).repartitionByRange(parts, *order).sortWithinPartitions(*order) \
        .mapInArrow(_joined_ids, _CHUNKS)
    return chunks.repartition(parts, *_KEY).sortWithinPartitions(*_KEY, "first") \
        .mapInArrow(_digested, _DIGESTS)


def prefix_trie(turns: DataFrame, ids: DataFrame, last_arcs: int = LAST_ARCS) -> DataFrame:
    """Nodes of the trie of all conversations in ``ids`` (conv_id, distinct), whose turns
    are (conv_id, seq, h1, h2, chars); one without turns belongs to the root alone.

    Returns per node conv_id (smallest member), depth, parent_conv_id (null at the root),
    n_convs, n_children, n_leaves, saved_tokens and ends_sha256. No conversations, no
    nodes. Rows repeated within a conversation are turns of their own."""
    prefixes = prefix_keys(turns)
    nodes = trie_nodes(prefixes, ids)
    places = tour_places(nodes)
    last = prefixes.groupBy("conv_id").agg(F.max(F.struct(*_KEY)).alias("_last"))
    zero = F.lit(0).cast("long")
    ends = ids.join(last, "conv_id", "left").select(
        "conv_id", *[F.coalesce(f"_last.{c}", zero).alias(c) for c in _KEY])
    digests = nodes.select(*_KEY, "conv_id").join(end_digests(ends), _KEY) \
        .select("conv_id", "depth", "digest")
    children = places.filter("parent is not null").groupBy(
        F.col("parent_conv_id").alias("conv_id"), (F.col("depth") - 1).alias("depth")) \
        .agg(F.count(F.lit(1)).alias("_children"))
    node = ["conv_id", "depth"]
    return places.join(subtree_sums(places, last_arcs), node).join(children, node, "left") \
        .join(digests, node, "left").select(
            "conv_id", "depth", "parent_conv_id", "n_convs",
            F.coalesce("_children", zero).alias("n_children"), "n_leaves", "saved_tokens",
            F.coalesce("digest", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = staged(hashed_turns(table(spark, sf_dir, "conversations")), "numbered-turns")
    ids = turns.filter("seq = 0").select("conv_id")
    return prefix_trie(share_first_turns(turns), ids)


SQL = r"""
WITH crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce([n, 1, 2, 3, 4, 5, 6, 7, 8],
    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END)) AS t),
ids AS (SELECT DISTINCT conv_id AS c FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 100 AS lowest,
         xor(list_reduce(list_concat([4294967295],
             list_transform(string_split(c::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
             lambda a, b: xor(t[(xor(a, b) & 255) + 1], a >> 8)), 4294967295) % 6 AS h
  FROM ids, crc_table),
own AS (
  SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) - 1 AS seq
  FROM conversations WHERE conv_id IS NOT NULL),
rebuilt AS (
  SELECT v.c, o.seq, o.role, o.text FROM convs v JOIN own o ON o.c = v.lowest AND o.seq < v.h
  UNION ALL
  SELECT v.c, o.seq, o.role, o.text FROM convs v JOIN own o ON o.c = v.c AND o.seq >= v.h),
paths AS (
  SELECT v.c, coalesce(r.turns, []) AS turns
  FROM ids v LEFT JOIN (SELECT c, list(sha256(concat(length(role), ':', role, text)) ORDER BY seq)
                               AS turns FROM rebuilt GROUP BY c) r ON r.c = v.c),
texts AS (SELECT DISTINCT sha256(concat(length(role), ':', role, text)) AS turn,
                 length(text) AS chars FROM rebuilt),
members AS (
  SELECT c, d, array_to_string(turns[:d], ' ') AS node, turns[d] AS turn, d = len(turns) AS ends,
         CASE WHEN d > 0 THEN array_to_string(turns[:d - 1], ' ') END AS parent
  FROM (SELECT c, turns, unnest(range(len(turns) + 1)) AS d FROM paths)),
nodes AS (
  SELECT d, node, any_value(parent) AS parent, min(c) AS c, count(*) AS n,
         (count(*) - 1) * coalesce(any_value(chars), 0) AS saved,
         sha256(coalesce(string_agg(CASE WHEN ends THEN c::VARCHAR END, ',' ORDER BY c), ''))
           AS ends_sha256
  FROM members m LEFT JOIN texts t ON t.turn = m.turn GROUP BY d, node),
families AS (SELECT d - 1 AS d, parent AS node, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
ancestors AS (
  SELECT DISTINCT n.d, n.node, n.saved, (f.n IS NULL)::INT AS leaf, m.d AS up, m.node AS top
  FROM nodes n LEFT JOIN families f ON f.d = n.d AND f.node = n.node
  JOIN members l ON l.d = n.d AND l.node = n.node AND l.c = n.c
  JOIN members m ON m.c = n.c AND m.d <= n.d),
subtrees AS (SELECT up AS d, top AS node, sum(leaf) AS leaves, sum(saved) AS saved
             FROM ancestors GROUP BY 1, 2)
SELECT n.c AS conv_id, n.d AS depth, p.c AS parent_conv_id, n.n AS n_convs,
       coalesce(f.n, 0) AS n_children, s.leaves::BIGINT AS n_leaves,
       s.saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s ON s.d = n.d AND s.node = n.node
LEFT JOIN families f ON f.d = n.d AND f.node = n.node
LEFT JOIN nodes p ON p.d = n.d - 1 AND p.node = n.parent
"""
