"""Mixing sources to target weights (7): pivotal dependent rounding of copy numbers.

Method
------
* A source's expected copies of each of its documents is target / source size (0 to ``MAX_REPEAT``): the whole part
  is taken for sure, the fraction is rounded by the pivotal method.
* A document's fractional mass (fraction times its size in words) is an integer in units of 1 / ``UNIT`` word.  Two
  documents meet; mass moves from one to the other until one of them is at 0 or full, up or down at random with the
  odds that keep both expectations.  So the source's words stay exact, and one document at most stays fractional.
* The meetings form a reduction tree: documents of a source are dealt by a hash into leaves of about ``LEAF``; the one
  residual of every leaf goes to the next level, ``FAN`` leaves to a node, until one residual per source is left,
  which a last draw rounds.  A source of any size is spread over its leaves; one task never sees it whole.
* All draws are hashes of the seed and the ids that meet, in a fixed order, so reruns and other partitionings agree.

Targets: sources by code point (null last) weigh 5, 2, 1, repeating, and share ``SHARE`` of all words; a target stops at
``MAX_REPEAT`` times its source's size and the excess is reshared by weight until none is above.

Defined results: texts without words have size 0 and take 0 words; sources of size 0 have target 0; null ids are
dealt like any other id; repeated rows are rows of their own; an empty table gives no rows.  Extra columns stay.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from riskframe.llm.store import written
from riskframe.llm.words import releasing

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MAX_REPEAT = 2
LEAF = 2000
FAN = 256
UNIT = 1 << 20
SEED = 20


def targets(sizes: DataFrame, share: float = SHARE) -> DataFrame:
    """(rank, source, source_size, n_docs, target) from rows (source, size).

    The water level is found by rounds over the table of sources; three numbers a round reach the driver.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n_docs"))
    ordered = written(per, "sources").orderBy(F.col("source").asc_nulls_last())
    schema = T.StructType([*ordered.schema.fields, T.StructField("rank", T.LongType())])
    ranked = written(sizes.sparkSession.createDataFrame(ordered.rdd.zipWithIndex().map(lambda r: (*r[0], r[1])), schema), "ranked")
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in WEIGHTS]), (F.col("rank") % len(WEIGHTS) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("most", F.col("source_size") * MAX_REPEAT)
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = 0.0, -1
    while True:  # a source is full once its share of the level reaches its bound; full ones stay full
        capped = F.col("weight") * level >= F.col("most")
        # sums of whole numbers: the same in any order, so that reruns agree to the last bit
        row = ranked.agg(F.sum(capped.cast("long")), F.sum(F.when(capped, F.col("most")).otherwise(0)), F.sum(F.when(capped, 0).otherwise(F.col("weight")))).first()
        if row[0] is None or row[0] == full or not row[2]:
            break
        full, level = row[0], (total - row[1]) / row[2]
    most = F.col("most").cast("double")
    bound = F.when(F.col("weight") * level >= most, most).otherwise(F.col("weight") * level)
    everything = total >= (ranked.agg(F.sum("most")).first()[0] or 0)
    return ranked.withColumn("target", most if everything else bound).select("rank", "source", "source_size", "n_docs", "target")


def _draw(*parts) -> float:
    return (xxhash.xxh3_64_intdigest(":".join(map(str, parts)).encode()) >> 11) / float(1 << 53)


def meet(seed: int, a: list, b: list) -> None:
    """Move mass between two (name, full, mass) until one of them is empty or full."""
    up, down = min(a[1] - a[2], b[2]), min(a[2], b[1] - b[2])
    if _draw(seed, a[0], b[0]) * (up + down) < down:
        a[2], b[2] = a[2] + up, b[2] - up
    else:
        a[2], b[2] = a[2] - down, b[2] + down


def _pivot(columns: list[str], seed: int):
    """Rows sorted by (__rank, __node): settle each node's rows but one; ``__open`` marks that one."""
    at = {c: columns.index(c) for c in ("__rank", "__node", "__name", "__full", "__mass")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, waiting = None, None  # the open document of the current node: (name, full, mass) and its row
        schema = None
        for batch in batches:
            rank, place, name, full, mass = (batch.column(at[c]).to_pylist() for c in ("__rank", "__node", "__name", "__full", "__mass"))
            held = waiting[1] if waiting else None
            base = 0 if held is None else 1
            table = pa.Table.from_batches([batch] if held is None else [held, batch])
            schema = schema or table.schema
            masses = ([waiting[0][2]] if waiting else []) + mass
            settled = [False] * len(masses)
            open_at = 0 if waiting else None
            state = waiting[0] if waiting else None
            for i in range(len(mass)):
                row = i + base
                if (rank[i], place[i]) != node:  # what was open stays open
                    node, open_at, state = (rank[i], place[i]), None, None
                if mass[i] in (0, full[i]):
                    settled[row] = True
                    continue
                mine = [name[i], full[i], mass[i]]
                if state is None:
                    open_at, state = row, mine
                    continue
                meet(seed, state, mine)
                masses[open_at], masses[row] = state[2], mine[2]
                if state[2] in (0, state[1]):
                    settled[open_at] = True
                    open_at, state = row, mine
                else:
                    settled[row] = True
                if state[2] in (0, state[1]):
                    settled[open_at] = True
                    open_at, state = None, None
            table = table.set_column(at["__mass"], table.schema.field("__mass"), pa.array(masses, pa.int64()))
            if open_at is not None:  # may still meet rows of the next batch
                waiting = (state, table.slice(open_at, 1).combine_chunks().to_batches()[0])
                keep = [i for i in range(len(masses)) if i != open_at]
            else:
                waiting, keep = None, list(range(len(masses)))
            out = table.take(pa.array(keep, pa.int64())).append_column("__open", pa.array([not settled[i] for i in keep], pa.bool_()))
            yield from out.to_batches()
        if waiting:
            yield from pa.Table.from_batches([waiting[1]]).append_column("__open", pa.array([True])).to_batches()

    return run


def _settle(rows: DataFrame, seed: int) -> DataFrame:
    dealt = rows.repartition("__rank", "__node").sortWithinPartitions("__rank", "__node", "__order", "__name")
    return dealt.mapInArrow(releasing(_pivot(rows.columns, seed)), T.StructType([*rows.schema.fields, T.StructField("__open", T.BooleanType())]))


def mixed(df: DataFrame, id_col: str = "doc_id", source_col: str = "source", size_col: str = "size", share: float = SHARE, seed: int = SEED,
          prefix: str = "") -> DataFrame:
    """All columns of ``df`` and source_size, target (its source's) and copies (how often the mix takes the row).

    Columns of ``df`` that have the names of the new ones (after ``prefix``) are replaced.
    """
    source = F.col(source_col).cast("string")
    per = written(targets(df.select(source.alias("source"), F.col(size_col).cast("long").alias("size")), share), "targets")
    deepest = per.agg(F.max("n_docs")).first()[0]
    leaves = F.ceil(F.col("__docs") / F.lit(LEAF)).cast("long")
    expected = F.when(F.col("__total") > 0, F.col("__target") / F.col("__total")).otherwise(F.lit(0.0))
    whole = F.floor(expected + F.lit(1e-12)).cast("long")
    name = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    base = df.drop(*(prefix + c for c in ("source_size", "target", "copies")))
    stats = per.select(F.col("source").alias("__source"), F.col("rank").alias("__rank"), F.col("n_docs").alias("__docs"),
                       F.col("source_size").alias("__total"), F.col("target").alias("__target"))
    rows = (base.join(stats, source.eqNullSafe(F.col("__source")))
            .withColumn("__order", F.xxhash64(F.lit(seed), name)).withColumn("__name", name)
            .withColumn("__whole", whole)
            .withColumn("__node", F.pmod(F.xxhash64(F.lit(seed + 1), name), leaves))
            .withColumn("__full", F.col(size_col).cast("long") * UNIT)
            .withColumn("__mass", F.greatest(F.lit(0).cast("long"), F.least(F.col("__full"), F.round((expected - whole) * F.col("__full")).cast("long"))))
            .drop("__source", "__docs"))
    settled = written(_settle(rows, seed), "leaves")

    # The residuals climb the tree; at each level a node keeps one open, and tells the others how they ended.
    step = ["__rank", "__leaf", "__node", "__order", "__name", "__full", "__mass"]
    climbing = settled.where("__open").select("__rank", F.col("__node").alias("__leaf"), F.floor(F.col("__node") / FAN).alias("__node"), "__order", "__name", "__full", "__mass")
    ended, width = [], -(-(deepest or 1) // LEAF)
    while width > 1:
        done = written(_settle(climbing, seed), "level")
        ended.append(done.where("not __open").select(*step))
        climbing = done.where("__open").select(*step[:2], F.floor(F.col("__node") / FAN).alias("__node"), *step[3:])
        width = -(-width // FAN)
    last = F.xxhash64(F.lit(seed + 2), "__rank", "__name")
    chance = F.shiftrightunsigned(last, 11) / F.lit(float(1 << 53))
    final = climbing.withColumn("__mass", F.when(chance * F.col("__full") < F.col("__mass"), F.col("__full")).otherwise(F.lit(0).cast("long")))
    for part in ended:
        final = final.select(*step).unionByName(part)
    # one row for each leaf that had a residual
    ends = final.select(F.col("__rank").alias("__r"), F.col("__leaf").alias("__l"), F.col("__mass").alias("__end"))
    joined = settled.join(ends, settled["__open"] & (F.col("__rank") == F.col("__r")) & (F.col("__node") == F.col("__l")), "left")
    mass = F.when(F.col("__open"), F.col("__end")).otherwise(F.col("__mass"))
    copies = (F.col("__whole") + F.when((F.col("__full") > 0) & (mass >= F.col("__full")), 1).otherwise(0)).cast("long")
    return joined.select(*base.columns, F.col("__total").alias(prefix + "source_size"), F.col("__target").alias(prefix + "target"), copies.alias(prefix + "copies"))
