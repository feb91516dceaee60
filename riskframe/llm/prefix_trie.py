"""Conversation prefix trie (13): burst tries.

A conversation is the sequence of its turns (role, text); a turn's id is 128 bits of the SHA-256 of both.  Nodes of the trie
are the distinct prefixes of all conversations.

1. *Equal conversations are one entry* (members counted, smallest member kept), so a group of copies is one row
   whatever its size.  The hash of the members of such a group is computed over sorted runs: runs are packed in
   parallel by range, and only packed runs meet to be hashed in order.
2. *Containers.*  All entries start in one suffix container below the root.  A container with more than ``LIMIT`` turns left
   bursts: the turns that all its entries share become a chain of trie heads (so a long common opening costs one round), and the
   entries move on, by next turn id, into containers below the last of them.  Rounds end when no container is oversized.
3. *Sweep.*  The remaining containers are dealt over the tasks by hash of their head, sorted, and swept into nodes with a stack.
   A task holds one container (``LIMIT`` turns, or a single entry) at a time.
4. Leaves and saved bytes of the containers are added up towards the root, one round of bursts at a time.

The table of one conversation's turns is one row (16 + 8 bytes a turn); this is the only thing that has to fit in a task whole.

Defined results: rows without conversation id take no part; null role or text: empty; turns of equal number are ordered by their id;
repeated turns count; of negative ids the remainder is negative, as in SQL; an empty table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskframe.llm.store import written

#: Turns (and ends) that a container may hold without bursting.
LIMIT = 1 << 15
#: Member ids in one packed run.
RUN = 1 << 14
ROOT = b"\0" * 16
EMPTY = hashlib.sha256(b"").hexdigest()


def _digest(c: Column) -> Column:
    return F.substring(F.unhex(F.sha2(c, 256)), 1, 16)


def turns_of(rows: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(c, pos, turn, size) of every turn: place from 0, id and UTF-8 bytes of its text."""
    role, text = (F.coalesce(F.col(x).cast("string"), F.lit("")) for x in (role_col, text_col))
    ids = rows.select(F.col(id_col).cast("long").alias("c"), F.col(turn_col).alias("nr"),
                      _digest(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary")).alias("turn"),
                      F.octet_length(text).cast("long").alias("size")).where("c is not null")
    order = W.partitionBy("c").orderBy(F.col("nr").asc_nulls_first(), "turn")
    return ids.select("c", (F.row_number().over(order) - 1).alias("pos"), "turn", "size")


def shared_turns(c: Column) -> Column:
    """How many opening turns a conversation takes from the one that it is forked from."""
    return (F.crc32(c.cast("string").cast("binary")) % 9).cast("int")


def rebuilt(turns: DataFrame) -> DataFrame:
    """(c, path, sizes): the first h turns of conversation c - c % 5, then the own turns after the first h."""
    turns = written(turns, "turns")
    ids = turns.select("c").distinct()
    own = turns.where(F.col("pos") >= shared_turns(F.col("c"))).select("c", F.lit(1).alias("part"), "pos", "turn", "size")
    fork = (turns.where("c % 5 = 0 and pos < 8").select("c", F.explode(F.sequence(F.lit(-4), F.lit(4))).alias("k"), "pos", "turn", "size")
            .select(F.col("c").alias("base"), F.try_add(F.col("c"), F.col("k").cast("long")).alias("c"), F.lit(0).alias("part"), "pos", "turn", "size")
            .where(F.col("c").isNotNull() & (F.col("c") - F.col("c") % 5 == F.col("base")) & (F.col("pos") < shared_turns(F.col("c")))).drop("base"))
    none = ids.select("c", *[F.lit(None).cast(t).alias(n) for n, t in (("part", "int"), ("pos", "int"), ("turn", "binary"), ("size", "long"))])
    all_turns = own.unionByName(fork.join(ids, "c", "left_semi")).unionByName(none)
    listed = F.sort_array(F.collect_list(F.when(F.col("part").isNotNull(), F.struct("part", "pos", "turn", "size"))))
    return all_turns.groupBy("c").agg(listed.alias("t")).select("c", F.col("t.turn").alias("path"), F.col("t.size").alias("sizes"))


# ------------------------------------------------------------------ entries
def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, c) -> (key, smallest c, comma-joined ids) of runs of at most ``RUN`` ids."""
    key, run = None, []

    def out():
        return pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([run[0]], pa.int64()), pa.array([",".join(map(str, run))])], names=["key", "least", "run"])

    for batch in batches:
        for k, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if run and (k != key or len(run) >= RUN):
                yield out()
                run = []
            key = k
            run.append(c)
    if run:
        yield out()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs sorted by (key, smallest c) -> (key, SHA-256 of all ids of the key)."""
    key, state = None, None
    names = ["key", "many"]
    for batch in batches:
        for k, run in zip(batch.column(0).to_pylist(), batch.column(2), strict=True):
            if k != key:
                if key is not None:
                    yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=names)
                key, state = k, hashlib.sha256()
            else:
                state.update(b",")
            state.update(run.as_py().encode())
    if key is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], names=names)


def entries(conversations: DataFrame) -> DataFrame:
    """One row per distinct path: (path, sizes, w members, smallest member, hash of the members)."""
    keyed = written(conversations.withColumn("key", _digest(F.array_join(F.transform("path", F.hex), "").cast("binary"))), "rebuilt")
    groups = keyed.groupBy("key").agg(F.first("path").alias("path"), F.first("sizes").alias("sizes"), F.count("*").alias("w"), F.min("c").alias("least"))
    groups = written(groups, "entries")
    members = keyed.select("key", "c").join(groups.where("w > 1").select("key"), "key", "left_semi").select("key", "c")
    runs = members.repartitionByRange("key", "c").sortWithinPartitions("key", "c").mapInArrow(_packed, "key binary, least long, run string")
    many = runs.repartition("key").sortWithinPartitions("key", "least").mapInArrow(_hashed, "key binary, many string")
    ends = F.coalesce("many", F.sha2(F.col("least").cast("string").cast("binary"), 256)).alias("ends")
    return groups.join(many, "key", "left").select("path", "sizes", "w", "least", ends)


# ------------------------------------------------------------------ bursts
def _burst(held: DataFrame, oversized: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(trie heads, entries in the containers below them) of the oversized containers."""
    moved = held.join(oversized.select("head", "fork", "conv"), "head")
    ended = F.size("path") == F.col("fork")
    child = F.when(~ended, _digest(F.concat("head", F.element_at("path", F.when(ended, 1).otherwise(F.col("fork") + 1)))))
    moved = written(moved.withColumn("child", F.when(F.size("path") > 0, child)), "moved")
    chain = F.slice("sizes", F.greatest("depth", F.lit(1)), F.col("fork") - F.greatest("depth", F.lit(1)) + 1)
    heads = moved.groupBy("head").agg(F.first(chain).alias("chain"), F.count_distinct("child").alias("n_children"), F.max(F.when(F.col("child").isNull(), F.col("ends"))).alias("ends"))
    below = moved.where("child is not null").select(F.col("child").alias("head"), F.col("head").alias("up"), F.col("conv").alias("up_conv"), (F.col("fork") + 1).alias("depth"),
                                                    "path", "sizes", "w", "least", "ends")
    return written(oversized.join(heads, "head"), "heads"), below


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Entries sorted by (head, path) -> the nodes of every container."""
    names = ["head", "up", "stage", "top", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    types = [pa.binary(), pa.binary(), pa.int32(), pa.bool_(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string()]

    def nodes(box: list[dict]) -> pa.RecordBatch:
        first = box[0]
        depth, size, parent, ends, n, least = [], [], [], [], [], []
        stack: list[int] = []

        def push(d: int, bytes_: int) -> None:
            depth.append(d)
            size.append(bytes_)
            parent.append(stack[-1] if stack else -1)
            ends.append(EMPTY)
            n.append(0)
            least.append(None)
            stack.append(len(depth) - 1)

        base, before = first["depth"], None
        push(base, first["sizes"][base - 1] if base else 0)
        for e in box:
            path, sizes = e["path"], e["sizes"]
            same = base
            if before is not None:
                most = min(len(path), len(before))
                while same < most and path[same] == before[same]:
                    same += 1
                del stack[same - base + 1 :]
            for d in range(same, len(path)):
                push(d + 1, sizes[d])
            at = stack[-1]
            ends[at], n[at], least[at] = e["ends"], n[at] + e["w"], e["least"]
            before = path
        count = len(depth)
        children, leaves, saved = [0] * count, [0] * count, [0] * count
        for i in range(count - 1, -1, -1):  # a node comes after its parent
            leaves[i] = leaves[i] or 1
            saved[i] += (n[i] - 1) * size[i]
            if (p := parent[i]) >= 0:
                children[p] += 1
                leaves[p] += leaves[i]
                saved[p] += saved[i]
                n[p] += n[i]
                least[p] = least[i] if least[p] is None else min(least[p], least[i])
        above = [first["up_conv"] if p < 0 else least[p] for p in parent]
        columns = [[first["head"]] * count, [first["up"]] * count, [first["stage"]] * count, [p < 0 for p in parent], least, depth, above, n, children, leaves, saved, ends]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    box: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            if box and row["head"] != box[0]["head"]:
                yield nodes(box)
                box = []
            box.append(row)
    if box:
        yield nodes(box)


def trie(conversations: DataFrame, limit: int = LIMIT) -> DataFrame:
    """Nodes of the trie over (c, path, sizes)."""
    held = entries(conversations).select(F.lit(ROOT).alias("head"), F.lit(None).cast("binary").alias("up"), F.lit(None).cast("long").alias("up_conv"), F.lit(0).alias("depth"),
                                         "path", "sizes", "w", "least", "ends")
    rounds: list[DataFrame] = []
    resting: DataFrame | None = None
    while True:
        held = written(held, "held")
        # entries differ, so the smallest and the largest path of several part somewhere: what comes before is shared by all
        fork = F.array_position(F.zip_with("low", "high", lambda a, b: a.eqNullSafe(b)), False) - 1
        boxes = held.groupBy("head").agg(F.first("up").alias("up"), F.first("up_conv").alias("up_conv"), F.first("depth").alias("depth"), F.count("*").alias("n"),
                                         F.sum(F.size("path") - F.col("depth") + 1).alias("turns"), F.min("path").alias("low"), F.max("path").alias("high"),
                                         F.sum("w").alias("members"), F.min("least").alias("conv"))
        oversized = written(boxes.where(f"n > 1 and turns > {limit}").select("head", "up", "up_conv", "depth", fork.cast("int").alias("fork"), "members", "conv"), "oversized")
        last = oversized.isEmpty()
        stay = held if last else held.join(oversized.select("head"), "head", "left_anti")
        stay = stay.withColumn("stage", F.lit(len(rounds)))
        resting = stay if resting is None else resting.unionByName(stay)
        if last:
            break
        heads, held = _burst(held, oversized)
        rounds.append(heads)
    node = "conv_id long, depth int, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
    swept = written(resting.repartition("head").sortWithinPartitions("head", "path").mapInArrow(_swept, f"head binary, up binary, stage int, top boolean, {node}"), "swept")

    names = [f.split()[0] for f in node.split(", ")]
    out, totals = swept.select(names), None
    for stage in range(len(rounds) - 1, -1, -1):
        below = swept.where(f"top and stage = {stage + 1}").select("up", "n_leaves", "saved_tokens")
        below = below if totals is None else below.unionByName(totals)
        sums = below.groupBy("up").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("under")).withColumnRenamed("up", "head")
        i = F.col("i")
        # the chain's node at depth i saves what it and the nodes below it in the chain save, and all that lies under the last
        from_here = F.slice("chain", F.greatest(i, F.lit(1)) - F.greatest("depth", F.lit(1)) + 1, F.size("chain"))
        chain = (rounds[stage].join(sums, "head").withColumn("i", F.explode(F.sequence("depth", "fork")))
                 .select("head", "up", (i == F.col("depth")).alias("top"), F.col("conv").alias("conv_id"), i.alias("depth"),
                         F.when(i == F.col("depth"), F.col("up_conv")).otherwise(F.col("conv")).alias("parent_conv_id"), F.col("members").alias("n_convs"),
                         F.when(i == F.col("fork"), F.col("n_children")).otherwise(1).cast("long").alias("n_children"), "n_leaves",
                         (F.col("under") + (F.col("members") - 1) * F.aggregate(from_here, F.lit(0).cast("long"), lambda a, v: a + v)).alias("saved_tokens"),
                         F.when(i == F.col("fork"), F.coalesce("ends", F.lit(EMPTY))).otherwise(EMPTY).alias("ends_sha256")))
        chain = written(chain, "chain")
        out = out.unionByName(chain.select(names))
        totals = chain.where("top").select("up", "n_leaves", "saved_tokens")
    return out


def conversation_trie(rows: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", limit: int = LIMIT) -> DataFrame:
    """The trie of the rebuilt conversations of ``rows``."""
    return trie(rebuilt(turns_of(rows, id_col, turn_col, role_col, text_col)), limit)
