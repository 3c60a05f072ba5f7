"""A trie of conversations, by collapsing whole sequences.

Conversations are rebuilt first (``rebuild``), each a sequence of turns. Turn d
of a rebuilt conversation has a 128-bit hash of d, role and text; a prefix is
known by its depth and the running sums of those hashes, so identity needs
neither texts nor an order of work, and running sums are taken in blocks of
``BLOCK`` turns whose totals are added up afterwards. No task holds a whole
conversation.

Identical rebuilt conversations collapse into one sequence with a weight and the
list of its ends. The anti-join of sequences with the proper prefixes of all
sequences leaves the leaves. Only one conversation of each sequence, the
smallest, is expanded into its prefixes, which are added up with their weights.

``saved_tokens`` of a node sums (members - 1) x bytes over its subtree without
walking it. The members' part is, over the member sequences, weight x bytes from
the node on. The rest is the bytes of the distinct nodes below: each node
belongs to the sequence of its smallest member, and those of one sequence are
the end of its path; so all nodes of a member sequence lie in the subtree, but
for the smallest member, whose path from the node on does.

Turns are ordered by turn, NULL first; the SHA-256 of role and text settles
ties, and repeated turns count each. NULL role and text are empty; texts of any
length are hashed whole. Rows without a conv_id belong to no conversation and
are left out. Other columns are ignored. An empty table gives no rows; else the
root is always there.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gridclime.llm.common import stage, unstage

GROUP, HEADS = 5, 9
#: Turns in a block of running sums, and conversation ids in a piece of an end list.
BLOCK, PIECE = 1024, 256
KEY = ["depth", "k1", "k2"]
_PARTITION = 2**33  # monotonically_increasing_id has the partition above these bits
_HALF = 2**32


def head_length(conv_id: str = "conv_id") -> Column:
    """How many turns a conversation takes over."""
    return (F.crc32(F.col(conv_id).cast("string")) % HEADS).cast("int")


def numbered(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, part, at, digest, bytes) and parts (conv_id, part, first, n, before), stored.

    Rows are sorted by ranges, so a conversation of any length is dealt over
    tasks. A row is turn ``before + at - first + 1`` of its conversation.
    """
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256).alias("digest"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    order = ["conv_id", "turn", "digest"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    turns = ranged.select("conv_id", "digest", "bytes", F.monotonically_increasing_id().alias("at"))
    turns = stage(turns.withColumn("part", F.floor(F.col("at") / _PARTITION)))
    parts = turns.groupBy("conv_id", "part").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # a row per range
    return turns, stage(parts.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))))


def rebuild(turns: DataFrame, parts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations (conv_id, n) and their rebuilt turns (conv_id, depth, digest, bytes).

    Conversation c begins with the first h turns of c - c % 5, as far as there
    are any, and goes on with its own turns after the first h.
    """
    own = parts.groupBy("conv_id").agg(F.sum("n").alias("own"))
    base = F.col("conv_id") - F.col("conv_id") % GROUP
    wanted = own.select("conv_id", "own", base.alias("base"), head_length().alias("h"))
    there = own.select(F.col("conv_id").alias("base"), F.col("own").alias("there"))
    plans = wanted.join(there, "base", "left").withColumn("there", F.coalesce("there", F.lit(0)))
    plans = plans.withColumn("taken", F.when(F.col("base") == F.col("conv_id"), F.lit(0)).otherwise(F.least("h", "there")))
    plans = plans.withColumn("skipped", F.when(F.col("base") == F.col("conv_id"), F.lit(0)).otherwise(F.col("h")))
    plans = stage(plans.select("conv_id", "base", "taken", "skipped", (F.col("taken") + F.greatest(F.col("own") - F.col("skipped"), F.lit(0))).alias("n")))
    # What depends on the conversation goes to its parts first; a turn meets its part only.
    located = parts.join(plans, "conv_id").select("conv_id", "part", "first", "before", "taken", "skipped")
    placed = turns.join(located.hint("merge"), ["conv_id", "part"])
    placed = placed.withColumn("place", F.col("before") + F.col("at") - F.col("first") + 1)
    kept = placed.where(F.col("place") > F.col("skipped")).select(
        "conv_id", (F.col("taken") + F.col("place") - F.col("skipped")).alias("depth"), "digest", "bytes"
    )
    heads = placed.where((F.col("conv_id") % GROUP == 0) & (F.col("place") < HEADS))  # at most 8 turns of a conversation
    heads = heads.select(F.col("conv_id").alias("base"), "place", "digest", "bytes")
    borrowed = plans.where("taken > 0").select("conv_id", "base", "taken").join(heads, "base").where("place <= taken")
    borrowed = borrowed.select("conv_id", F.col("place").alias("depth"), "digest", "bytes")
    return plans.select("conv_id", "n"), kept.unionByName(borrowed)


def prefixes(rebuilt: DataFrame, block: int = BLOCK) -> DataFrame:
    """(conv_id, depth, k1, k2, p1, p2, bytes, through): keys of a prefix and of the one before it, its last turn's
    bytes and those of all its turns; stored."""
    h = F.md5(F.concat_ws(":", "depth", "digest"))
    words = [F.conv(F.substring(h, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(4)]
    named = [w.alias(f"h{i}") for i, w in enumerate(words)]
    rows = stage(rebuilt.select("conv_id", "depth", "bytes", F.floor(F.col("depth") / block).alias("block"), *named))
    summed = ["h0", "h1", "h2", "h3", "bytes"]
    totals = rows.groupBy("conv_id", "block").agg(*[F.sum(c).alias(c) for c in summed])
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("conv_id", "block", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"o_{c}") for c in summed])
    within = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.select("conv_id", "block", "depth", "bytes", *[F.col(c).alias(f"own_{c}") for c in summed[:4]], *[F.sum(c).over(within).alias(f"s_{c}") for c in summed])
    joined = running.join(offsets.hint("merge"), ["conv_id", "block"])
    total = {c: F.col(f"s_{c}") + F.col(f"o_{c}") for c in summed}
    packed = lambda a, b: F.shiftleft(a % _HALF, 32).bitwiseOR(b % _HALF)
    keys = [packed(total[f"h{i}"], total[f"h{i + 1}"]).alias(f"k{i // 2 + 1}") for i in (0, 2)]
    less = {c: total[c] - F.col(f"own_{c}") for c in summed[:4]}
    keys += [packed(less[f"h{i}"], less[f"h{i + 1}"]).alias(f"p{i // 2 + 1}") for i in (0, 2)]
    return stage(joined.select("conv_id", "depth", *keys, "bytes", total["bytes"].alias("through")))


def end_hashes(members: DataFrame, piece: int = PIECE) -> DataFrame:
    """(depth, k1, k2, ends_sha256): SHA-256 of each sequence's conv_ids, ascending, joined by commas.

    Lists are joined to pieces of at most ``piece`` ids first. SHA-256 reads a
    list from end to end, so the pieces of one list meet in one task, which
    reads them one after the other and holds none.
    """
    pieces = members.groupBy(*KEY, F.floor(F.col("conv_id") / piece).alias("piece")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))).alias("ids")
    )
    dealt = pieces.repartition(*KEY).sortWithinPartitions(*KEY, "piece").select(*KEY, "ids")
    schema = "depth long, k1 long, k2 long, ends_sha256 string"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string())
        key, running = None, None
        for batch in batches:
            done = []
            for *own, ids in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if own == key:
                    running.update(b"," + ids.encode())
                    continue
                if key is not None:
                    done.append((*key, running.hexdigest()))
                key, running = own, hashlib.sha256(ids.encode())
            yield packed(done, kinds)
        if key is not None:
            yield packed([(*key, running.hexdigest())], kinds)

    def packed(rows: list[tuple], kinds: tuple) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=[*KEY, "ends_sha256"])

    return dealt.mapInArrow(work, schema)


def trie(conversations: DataFrame) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    turns, parts = numbered(conversations)
    convs, rebuilt = rebuild(turns, parts)
    paths = prefixes(rebuilt)
    unstage(turns)

    # Whole sequences: equal ones are one, under their smallest conversation.
    whole = paths.select("conv_id", *KEY, F.col("through").alias("total"))
    root = [F.lit(0).cast("long").alias(c) for c in ("k1", "k2", "total")]
    none = convs.where("n = 0").select("conv_id", F.col("n").alias("depth"), *root)
    members = whole.join(convs.select("conv_id", F.col("n").alias("depth")), ["conv_id", "depth"]).select("conv_id", *KEY, "total")
    members = stage(members.unionByName(none))
    sequences = members.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("w"), F.max("total").alias("total"))
    sequences = stage(sequences.withColumnRenamed("depth", "n"))

    # Prefixes of one conversation per sequence; the root is a prefix of each.
    chosen = sequences.select("conv_id", "n", "w", "total").hint("merge")
    deep = paths.join(chosen, "conv_id").select(
        "conv_id", *KEY, "p1", "p2", "bytes", (F.col("depth") < F.col("n")).alias("proper"), "w", (F.col("total") - F.col("through") + F.col("bytes")).alias("onward")
    )
    zero = F.lit(0).cast("long")
    tops = sequences.select(
        "conv_id", zero.alias("depth"), zero.alias("k1"), zero.alias("k2"), F.lit(None).cast("long").alias("p1"), F.lit(None).cast("long").alias("p2"),
        zero.alias("bytes"), (F.col("n") > 0).alias("proper"), "w", F.col("total").alias("onward"),
    )
    steps = stage(deep.unionByName(tops))
    inner = steps.where("proper").select(*KEY).distinct()
    leaves = sequences.join(inner.withColumnRenamed("depth", "n"), ["n", "k1", "k2"], "left_anti").select("conv_id", F.lit(1).alias("leaf"))

    # A node is owned by its smallest member; `owned` adds up the bytes of a sequence's own nodes.
    owners = steps.groupBy(*KEY).agg(F.min("conv_id").alias("conv_id"), F.max("bytes").alias("bytes"))
    owned = owners.groupBy("conv_id").agg(F.sum("bytes").alias("owned"))
    per_sequence = sequences.select("conv_id").join(leaves, "conv_id", "left").join(owned, "conv_id", "left")
    per_sequence = stage(per_sequence.select("conv_id", F.coalesce("leaf", F.lit(0)).alias("leaf"), F.coalesce("owned", F.lit(0)).alias("owned")))
    weighed = steps.join(per_sequence.hint("merge"), "conv_id").groupBy(*KEY).agg(
        F.min(F.struct("conv_id", "owned", "onward")).alias("first"),
        F.max("p1").alias("p1"),
        F.max("p2").alias("p2"),
        F.sum("w").alias("n_convs"),
        F.sum("leaf").alias("n_leaves"),
        F.sum(F.col("w") * F.col("onward")).alias("all_bytes"),
        F.sum("owned").alias("owned"),
    )
    distinct_bytes = F.col("owned") - F.col("first.owned") + F.col("first.onward")
    nodes = stage(weighed.select(F.col("first.conv_id").alias("conv_id"), *KEY, "p1", "p2", "n_convs", "n_leaves", (F.col("all_bytes") - distinct_bytes).alias("saved_tokens")))

    above = [(F.col("depth") - 1).alias("depth"), F.col("p1").alias("k1"), F.col("p2").alias("k2")]
    children = nodes.where("depth > 0").select(*above).groupBy(*KEY).agg(F.count("*").alias("n_children"))
    filled = nodes.join(children, KEY, "left").join(end_hashes(members.select(*KEY, "conv_id")), KEY, "left")
    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv_id").alias("parent_conv_id"))
    named = filled.join(parents.hint("merge"), ["depth", "p1", "p2"], "left")
    return named.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"),
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
