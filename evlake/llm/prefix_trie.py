"""The trie of conversation prefixes, from vertical bitmaps.

A conversation is a sequence of turns; every distinct sequence of first turns is a node
of the trie, and the conversations that start with it are its members. Conversations
are dealt into shards by ranges of their ids. A shard indexes its turns vertically: for
every position and turn a bitset says which conversations have that turn there. Going
down depth first, a node's children are its own bitset intersected with the postings of
the next position, one intersection per child; bit counts give the members, and those
without a turn at the next position end there. A node's name is a hash chained from its
parent's, so the shards' nodes are brought together by name: one row per shard and node,
however many conversations share it.

Sums over subtrees are taken in the shards too. Every node of the whole is owned by the
shard of its smallest member, which has all its ancestors; each shard sums what it owns
up its own tree, and the shards' sums are added by name.

A shard holds the turns of at most ``SHARD_IDS`` ids, 24 bytes a turn and no texts. So
one conversation is in one place, but never the conversations that share a prefix. The
ids that end at a node are packed by shard and hashed as a stream in order.

Defined results: a null text or role is empty; turns come in the order of their number
(null first), rows of one number by their content; rows repeated in full are turns of
their own; rows without a conversation id belong to no conversation and are left out.
Texts are compared by MD5 of role and text. An empty table has no node.
"""

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from evlake.llm.common import stored, with_lookup

#: Ids of a shard.
SHARD_IDS = 320

#: A turn: its conversation, its place there, a digest of role and text (null says that
#: the conversation exists and nothing else) and the words of the text.
TURNS = "conv long, place long, token binary, words long"
_NODES = (
    "shard long, path binary, parent binary, depth long, n_convs long, conv_id long, words long, ends array<long>"
)


def turns_of(
    conversations: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """The turns of ``conversations``, placed 0, 1, ... in each."""
    said, by = F.coalesce(F.col(text), F.lit("")), F.coalesce(F.col(role).cast("string"), F.lit(""))
    turns = conversations.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv"),
        F.col(turn).cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(by), F.lit(":"), by, said))).alias("token"),
        F.regexp_count(said, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv").orderBy(F.asc_nulls_first("turn"), "token")
    return turns.select("conv", (F.row_number().over(order) - 1).cast("long").alias("place"), "token", "words")


def rebuilt(turns: DataFrame, span: int = 20, most: int = 4) -> DataFrame:
    """Conversations whose first turns are those of another one.

    Of conversation c the first h turns, h = crc32(c in decimal) % ``most``, are taken
    from conversation c - c % ``span``; its own follow from the h-th on. A conversation
    left without turns stays, as a row without a token.
    """
    turns = stored(turns, "turns")
    borrowed = F.crc32(F.col("conv").cast("string").cast("binary")) % most
    convs = turns.groupBy("conv").agg(F.count("*").alias("n_turns")).withColumn("h", borrowed)
    own = turns.where(F.col("place") >= borrowed)
    # Fewer than ``span`` conversations ask for one, and it gives fewer than ``most`` turns.
    first = turns.where((F.col("place") < most - 1) & (F.col("conv") % span == 0))
    first = first.select(F.col("conv").alias("base"), F.col("place").alias("from"), "token", "words")
    asked = convs.where("h > 0").withColumn("base", F.col("conv") - F.col("conv") % span)
    lent = asked.join(first, "base").where("from < h").select("conv", (F.col("from") - most).alias("place"), "token", "words")
    there = convs.select("conv", F.lit(None).cast("long"), F.lit(None).cast("binary"), F.lit(0).cast("long"))
    return own.union(lent).union(there)


def _column(batch: pa.Table, name: str) -> np.ndarray:
    return batch.column(name).to_numpy(zero_copy_only=False)


def _local_nodes(rows: pa.Table) -> pa.Table:
    """The trie of one shard."""
    shard = rows.column("shard")[0].as_py()
    all_conv = _column(rows, "conv")
    convs = np.unique(all_conv)
    named = rows.filter(pc.is_valid(rows.column("token")))
    conv, place = _column(named, "conv"), _column(named, "place")
    order = np.lexsort((place, conv))
    member = np.searchsorted(convs, conv[order])
    tokens, words = named.column("token").take(pa.array(order)).to_pylist(), _column(named, "words")[order]
    starts = np.searchsorted(member, np.arange(len(convs)))

    postings: dict[tuple[int, bytes], int] = defaultdict(int)
    going_on: dict[int, int] = defaultdict(int)
    for i, m in enumerate(member.tolist()):
        depth = i - int(starts[m])
        postings[depth, tokens[i]] |= 1 << m
        going_on[depth] |= 1 << m

    out: dict[str, list] = {k: [] for k in ("path", "parent", "depth", "n_convs", "conv_id", "words", "ends")}
    stack = [(b"", None, 0, (1 << len(convs)) - 1, 0)]
    while stack:
        path, parent, depth, bits, said = stack.pop()
        rest = bits & going_on.get(depth, 0)
        ends, ending = [], bits ^ rest
        while ending:
            low = ending & -ending
            ends.append(int(convs[low.bit_length() - 1]))
            ending ^= low
        row = (path, parent, depth, bits.bit_count(), int(convs[(bits & -bits).bit_length() - 1]), said, ends)
        for values, value in zip(out.values(), row, strict=True):
            values.append(value)
        while rest:
            at = int(starts[(rest & -rest).bit_length() - 1]) + depth
            child = bits & postings[depth, tokens[at]]
            stack.append((hashlib.md5(path + tokens[at]).digest(), path, depth + 1, child, int(words[at])))
            rest &= ~child
    n = len(out["path"])
    types = [pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64())]
    columns = [pa.array([shard] * n, pa.int64())]
    columns += [pa.array(v, t) for v, t in zip(out.values(), types, strict=True)]
    return pa.table(columns, names=["shard", *out])


def _subtree_sums(rows: pa.Table) -> pa.Table:
    """What a shard owns, summed up its tree. Rows without ``owned`` give the tree, the
    others what nodes add."""
    leaves: dict[bytes, int] = defaultdict(int)
    saved: dict[bytes, int] = defaultdict(int)
    tree = []
    fields = zip(*(rows.column(c).to_pylist() for c in ("path", "parent", "depth", "owned", "leaf", "saved")), strict=True)
    for path, parent, depth, owned, leaf, own_saved in fields:
        if owned:
            leaves[path] += leaf
            saved[path] += own_saved
        else:
            tree.append((depth, path, parent))
    for _, path, parent in sorted(tree, key=lambda t: -t[0]):
        if parent is not None:
            leaves[parent] += leaves[path]
            saved[parent] += saved[path]
    kept = [p for p in saved if leaves[p] or saved[p]]
    return pa.table(
        [pa.array(kept, pa.binary()), pa.array([leaves[p] for p in kept], pa.int64()), pa.array([saved[p] for p in kept], pa.int64())],
        names=["path", "n_leaves", "saved_tokens"],
    )


def _hashed_ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per path from its rows, which come together and in order of their ids."""
    path, digest = None, None

    def row():
        return pa.RecordBatch.from_arrays(
            [pa.array([path], pa.binary()), pa.array([digest.hexdigest()])], ["path", "ends_sha256"]
        )

    for batch in batches:
        for name, ids in zip(batch.column("path").to_pylist(), batch.column("ends").to_pylist(), strict=True):
            text = ",".join(map(str, ids)).encode()
            if name == path:
                digest.update(b"," + text)
                continue
            if path is not None:
                yield row()
            path, digest = name, hashlib.sha256(text)
    if path is not None:
        yield row()


def prefix_trie(turns: DataFrame) -> DataFrame:
    """A row per node of the trie of ``turns`` (columns of :data:`TURNS`): conv_id (the
    smallest member), depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens
    and ends_sha256."""
    # Truncating division keeps the order of ids.
    dealt = turns.withColumn("shard", F.expr(f"conv div {SHARD_IDS}"))
    local = stored(dealt.groupBy("shard").applyInArrow(_local_nodes, _NODES), "trie-shards")
    nodes = local.groupBy("path").agg(
        F.min("parent").alias("parent"),
        F.min("depth").alias("depth"),
        F.sum("n_convs").alias("n_convs"),
        F.min("conv_id").alias("conv_id"),
        F.min("words").alias("words"),
    )
    children = nodes.where("parent is not null").groupBy(F.col("parent").alias("path")).agg(F.count("*").alias("n_children"))
    nodes = stored(
        nodes.join(children, "path", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0))), "trie-nodes"
    )

    tree = local.select(
        "shard", "path", "parent", "depth", F.lit(False).alias("owned"), F.lit(0).cast("long").alias("leaf"),
        F.lit(0).cast("long").alias("saved"),
    )
    saved = (F.col("n_convs") - 1) * F.col("words")
    owned = nodes.select(
        F.expr(f"conv_id div {SHARD_IDS}").alias("shard"), "path", "parent", "depth", F.lit(True).alias("owned"),
        (F.col("n_children") == 0).cast("long").alias("leaf"), saved.alias("saved"),
    ).where("leaf > 0 or saved > 0")
    sums = tree.unionByName(owned).groupBy("shard").applyInArrow(_subtree_sums, "path binary, n_leaves long, saved_tokens long")
    sums = sums.groupBy("path").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))

    ending = local.where(F.size("ends") > 0).select("path", "ends")
    ending = ending.repartition("path").sortWithinPartitions("path", F.col("ends")[0])
    hashes = ending.mapInArrow(_hashed_ends, "path binary, ends_sha256 string")

    known = nodes.join(sums, "path", "left").join(hashes, "path", "left")
    # Parents by their number of children, so that one with very many is looked up.
    parents = nodes.where("n_children > 0").select(
        F.col("path").alias("parent"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("__n")
    )
    top = known.where("parent is null").withColumn("parent_conv_id", F.lit(None).cast("long"))
    below = with_lookup(known.where("parent is not null"), parents, ["parent"], "__n", nodes.count())
    return top.unionByName(below).select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
        F.coalesce("saved_tokens", F.lit(0)).alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
