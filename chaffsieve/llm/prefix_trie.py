"""The prefix trie of conversations, found by collapsing whole sequences first.

Identical conversations become one weighted sequence with the list of those
that end there; sequences that another one begins with go by an anti-join, and
what is left are the leaves; the prefixes of the weighted sequences are summed
to nodes.  All frames are narrow: a turn is the MD5 digest of its role and
text, a prefix the XOR of two 64-bit hashes of (place, digest) over its turns,
so a prefix costs 16 bytes whatever its length and equal pairs of hashes count
as equal prefixes.

Sums over subtrees need no walk.  The sequence with the smallest conversation
among all that pass a node stands for the node, and the nodes it stands for
are the end of its own path.  Bytes below a node are then summed twice over
the sequences through it: all the bytes that follow, times the weight, less
the bytes of the nodes that a sequence stands for.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from chaffsieve.config import AuditConfig
from chaffsieve.llm.tables import meet
from chaffsieve.operators.lookup import keyed_lookup
from chaffsieve.operators.order import dense_positions
from chaffsieve.sources.staging import stage

GROUP = 5  # conversations that share the beginning of one
HEADS = 9  # how many lengths that beginning may have
BLOCK = 4096  # turns of a conversation that one window orders
CHUNK = 1 << 16  # conversation ids joined before they are shuffled

NODE = ["depth", "key1", "key2"]


def rebuild(conversations: DataFrame, group: int = GROUP, heads: int = HEADS) -> tuple[DataFrame, DataFrame]:
    """Staged (members, turns) of the rebuilt conversations.

    ``members`` has one row per conversation (conv_id, base, head, length),
    ``turns`` one per rebuilt turn (conv_id, place, length, digest, bytes,
    from_conv, from_place): turn ``from_place`` of ``from_conv`` stands at
    ``place``.  Conversation c takes the first h = crc32(c) % ``heads`` turns
    of c - c % ``group``, then its own after its first h.

    A NULL turn number comes first; turns that share one are ordered by role,
    then by digest.  A NULL role or text is empty.  Rows without a conv_id
    belong to no conversation.  Other columns are ignored.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    role = F.coalesce(F.col("role"), F.lit(""))
    digest = F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary")))
    rows = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        "turn",
        role.alias("role"),
        digest.alias("digest"),
        F.octet_length(text).cast("bigint").alias("bytes"),
        F.monotonically_increasing_id().alias("spread"),  # equal turns need not share a task
    )
    ordered = stage(
        dense_positions(rows, ["conv_id", "turn", "role", "digest", "spread"], "at").drop("turn", "role", "spread"),
        "trie-order",
    )
    sizes = stage(
        ordered.groupBy("conv_id").agg(F.min("at").alias("first"), F.count("*").alias("own")), "trie-sizes"
    )
    numbered = meet(ordered, sizes.select("conv_id", "first"), ["conv_id"]).select(
        "conv_id", (F.col("at") - F.col("first") + 1).alias("place"), "digest", "bytes"
    )
    named = sizes.select(
        "conv_id",
        "own",
        (F.col("conv_id") - F.col("conv_id") % group).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
    )
    bases = sizes.select(F.col("conv_id").alias("base"), F.col("own").alias("base_turns"))
    head = F.least("h", F.coalesce("base_turns", F.lit(0)))
    members = stage(
        named.join(bases.hint("merge"), "base", "left").select(
            "conv_id",
            "base",
            "h",
            head.alias("head"),
            (head + F.greatest(F.col("own") - F.col("h"), F.lit(0))).alias("length"),
        ),
        "trie-members",
    )
    own = meet(numbered, members.select("conv_id", "h", "head", "length"), ["conv_id"]).filter("place > h")
    own = own.select(
        "conv_id",
        (F.col("place") - F.col("h") + F.col("head")).alias("place"),
        "length",
        "digest",
        "bytes",
        F.col("conv_id").alias("from_conv"),
        F.col("place").alias("from_place"),
    )
    # At most heads - 1 turns per base, and at most 2 * group - 1 conversations take them.
    begun = numbered.filter(F.col("place") < heads).withColumnRenamed("conv_id", "base")
    begun = begun.join(members.filter("head > 0").hint("merge"), "base").filter("place <= head")
    begun = begun.select(
        "conv_id",
        "place",
        "length",
        "digest",
        "bytes",
        F.col("base").alias("from_conv"),
        F.col("place").alias("from_place"),
    )
    return members.drop("h"), stage(own.unionByName(begun), "trie-turns")


def _prefixes(turns: DataFrame, block: int) -> DataFrame:
    """(conv_id, depth, length, key1, key2, parent1, parent2, before, bytes) per rebuilt turn.

    ``before`` counts the bytes of the turns ahead.  A conversation is ordered
    in blocks; only those of more than one need what is carried over.
    """
    hashed = turns.select(
        "conv_id",
        F.col("place").alias("depth"),
        "length",
        "bytes",
        F.xxhash64("place", "digest").alias("e1"),
        F.xxhash64("digest", "place", F.lit(1)).alias("e2"),
        F.floor((F.col("place") - 1) / block).alias("block"),
    )
    totals = (
        hashed.filter(F.col("length") > block)
        .groupBy("conv_id", "block")
        .agg(F.bit_xor("e1").alias("t1"), F.bit_xor("e2").alias("t2"), F.sum("bytes").alias("t"))
    )
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carried = totals.select(
        "conv_id",
        "block",
        F.bit_xor("t1").over(earlier).alias("c1"),
        F.bit_xor("t2").over(earlier).alias("c2"),
        F.sum("t").over(earlier).alias("c"),
    )
    inside = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = hashed.select(
        "*",
        F.bit_xor("e1").over(inside).alias("k1"),
        F.bit_xor("e2").over(inside).alias("k2"),
        F.sum("bytes").over(inside).alias("upto"),
    )
    zero = F.lit(0).cast("bigint")
    whole = meet(running, stage(carried, "trie-carried"), ["conv_id", "block"], "left").select(
        "conv_id",
        "depth",
        "length",
        F.col("k1").bitwiseXOR(F.coalesce("c1", zero)).alias("key1"),
        F.col("k2").bitwiseXOR(F.coalesce("c2", zero)).alias("key2"),
        (F.col("upto") - F.col("bytes") + F.coalesce("c", zero)).alias("before"),
        "bytes",
        "e1",
        "e2",
    )
    # Taking the last turn out of a prefix leaves its parent.
    return whole.select(
        "*",
        F.col("key1").bitwiseXOR(F.col("e1")).alias("parent1"),
        F.col("key2").bitwiseXOR(F.col("e2")).alias("parent2"),
    ).drop("e1", "e2")


def end_lists(ends: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """(depth, key1, key2, first, ids): conv_ids of ``ends`` (conv_id, depth, key1, key2), ascending,
    comma-joined in chunks; a node's chunks follow each other by ``first``.

    Chunks are joined where a range partitioning by node and conv_id puts
    them, so that a node with very many ends is spread over tasks.
    """
    order = ["key1", "key2", "depth", "conv_id"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, ids = None, []
        done: list[tuple] = []
        for batch in batches:
            for *here, conv in zip(*(batch.column(c).to_pylist() for c in [*NODE, "conv_id"])):
                if ids and (here != node or len(ids) >= chunk):
                    done.append((*node, ids[0], ",".join(map(str, ids))))
                    ids = []
                    if len(done) >= 1024 or len(done[-1][-1]) > 1 << 16:
                        yield _chunks(done)
                        done = []
                node = here
                ids.append(conv)
        if ids:
            done.append((*node, ids[0], ",".join(map(str, ids))))
        if done:
            yield _chunks(done)

    return (
        ends.select(*NODE, "conv_id")
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .mapInArrow(run, "depth bigint, key1 bigint, key2 bigint, first bigint, ids string")
    )


def _chunks(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.string()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows), kinds)]
    return pa.RecordBatch.from_arrays(columns, names=[*NODE, "first", "ids"])


def end_digests(chunks: DataFrame) -> DataFrame:
    """(depth, key1, key2, ends_sha256): the SHA-256 of each node's whole list.

    A digest is sequential; a task streams the chunks of its nodes in order.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest, done = None, None, []

        def out(rows):
            columns = [pa.array(c, k) for c, k in zip(zip(*rows), [pa.int64()] * 3 + [pa.string()])]
            return pa.RecordBatch.from_arrays(columns, names=[*NODE, "ends_sha256"])

        for batch in batches:
            for *here, ids in zip(*(batch.column(c).to_pylist() for c in [*NODE, "ids"])):
                if here == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        done.append((*node, digest.hexdigest()))
                    node, digest = here, sha256()
                digest.update(ids.encode())
            if len(done) >= 1024:
                yield out(done)
                done = []
        if node is not None:
            yield out([*done, (*node, digest.hexdigest())])

    return (
        chunks.repartition(*NODE)
        .sortWithinPartitions(*NODE, "first")
        .mapInArrow(run, "depth bigint, key1 bigint, key2 bigint, ends_sha256 string")
    )


def prefix_trie(members: DataFrame, turns: DataFrame, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """Staged (nodes, ends) of the trie over ``rebuild``'s result.

    ``nodes``: depth, key1, key2, conv_id (the smallest member, which stands
    for the node), parent_conv_id, n_convs, n_children, n_leaves, bytes (of
    the last text), saved_tokens.  ``ends``: conv_id and the node it ends at.
    No conversation, no node.
    """
    cfg = AuditConfig()
    zero = F.lit(0).cast("bigint")
    prefixes = stage(_prefixes(turns, block), "trie-prefixes")

    # Whole sequences, weighted; conversations without turns are the root's.
    ends = prefixes.filter("depth = length").select(
        "conv_id", *NODE, (F.col("before") + F.col("bytes")).alias("total")
    )
    turnless = members.filter("length = 0").select(
        "conv_id", *[zero.alias(c) for c in NODE], zero.alias("total")
    )
    ends = stage(ends.unionByName(turnless), "trie-ends")
    sequences = ends.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("weight"), F.max("total").alias("total")
    )
    sequences = stage(sequences, "trie-sequences")
    proper = prefixes.filter("depth < length").select(*NODE).unionByName(
        prefixes.filter("depth = 1").select(*[zero.alias(c) for c in NODE])
    )
    leaves = sequences.join(proper.distinct().hint("merge"), NODE, "left_anti")
    leaves = leaves.select("conv_id", F.lit(1).cast("bigint").alias("leaf"))
    sequences = stage(
        sequences.join(leaves.hint("merge"), "conv_id", "left").fillna(0, ["leaf"]), "trie-weighted"
    )

    # The prefixes of each sequence once, by the conversation that stands for it.
    weights = sequences.select("conv_id", "weight", "total", "leaf")
    roots = weights.select(
        "conv_id",
        *[zero.alias(c) for c in NODE],
        *[F.lit(None).cast("bigint").alias(c) for c in ("parent1", "parent2")],
        zero.alias("before"),
        zero.alias("bytes"),
        "weight",
        "total",
        "leaf",
    )
    paths = stage(
        meet(prefixes.drop("length"), weights, ["conv_id"]).unionByName(roots), "trie-paths"
    )
    stands = paths.groupBy(*NODE).agg(F.min("conv_id").alias("conv_id"), F.min("before").alias("own_from"))
    branches = stands.groupBy("conv_id").agg(F.min("own_from").alias("own_from"))
    # A sequence inside the path of an earlier one stands for no node.
    own = F.col("total") - F.greatest("before", F.coalesce("own_from", "total"))
    nodes = meet(paths, stage(branches, "trie-branches"), ["conv_id"], "left").groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"),
        F.min("parent1").alias("parent1"),
        F.min("parent2").alias("parent2"),
        F.sum("weight").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"),
        F.min("bytes").alias("bytes"),
        F.sum(F.col("weight") * (F.col("total") - F.col("before")) - own).alias("saved_tokens"),
    )
    nodes = stage(nodes, "trie-nodes")

    counts = (
        nodes.filter("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), F.col("parent1").alias("key1"), F.col("parent2").alias("key2"))
        .agg(F.count("*").alias("n_children"))
    )
    nodes = stage(nodes.join(counts.hint("merge"), NODE, "left").fillna(0, ["n_children"]), "trie-counted")
    parents = nodes.filter("n_children > 0").select(
        (F.col("depth") + 1).alias("depth"),
        F.col("key1").alias("parent1"),
        F.col("key2").alias("parent2"),
        F.col("conv_id").alias("parent_conv_id"),
        "n_children",
    )
    found = keyed_lookup(
        nodes, stage(parents, "trie-parents"), ["depth", "parent1", "parent2"], "n_children", cfg, "left"
    )
    return found.drop("parent1", "parent2"), ends.drop("total")


def last_turns(nodes: DataFrame, turns: DataFrame) -> DataFrame:
    """``nodes`` with the place of their last turn in the table: from_conv, from_place; NULL for the root.

    ``turns`` are ``rebuild``'s.
    """
    places = turns.select("conv_id", F.col("place").alias("depth"), "from_conv", "from_place")
    return nodes.join(places, ["conv_id", "depth"], "left")


def trie(conversations: DataFrame, group: int = GROUP, heads: int = HEADS) -> DataFrame:
    """The nodes of the trie of the rebuilt ``conversations``, with digests of their end lists.

    An empty table gives no rows; see ``rebuild`` for NULLs and ties.  A very
    long conversation is ordered in blocks, a very common one is one sequence.
    """
    members, turns = rebuild(conversations, group, heads)
    nodes, ends = prefix_trie(members, turns)
    digests = end_digests(end_lists(ends))
    none = F.lit(sha256(b"").hexdigest())
    return nodes.join(digests.hint("merge"), NODE, "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", none).alias("ends_sha256"),
    )
