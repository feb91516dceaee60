"""Near duplicates (5): multi-index Hamming join over b-bit MinHash signatures.

Method
------
* A document is the set of its distinct 5-word shingles (ASCII-lower-cased words; fewer than five words: the
  whole sequence is the one shingle; no words: the empty set, linked with nothing).
* Its signature is ``HASHES`` symbols of 16 bits, each the low bits of one minimum hash.  Two sets of similarity
  J differ in a symbol with probability 1 - J, so at J = 0.75 the distance is Binomial(64, 1/4); ``MAX_DISTANCE``
  (31) lies 4.3 standard deviations above the mean (3e-5 of pairs at exactly 0.75 lie beyond, fewer above).
* Signatures are cut into 16 chunks of 4 symbols.  If two are at most 31 apart, some chunk has at most
  floor(31 / 16) = 1 differing symbol (pigeonhole), so the keys of a chunk are its 4 variants with one symbol left
  out: every pair within the distance shares at least one key, without exception.
* Next to the signature a sketch holds one byte for each of ``BINS`` ranges of hash values: of the smallest member there.
  Bins that differ witness different members of the symmetric difference, so more of them than a pair of these sizes
  may have at the similarity rule the pair out for certain; for large sets the share of differing bins is tested
  as well, ``SURE`` standard deviations above its mean (a link lies beyond with probability below 1e-11).
* Identical sets are one node.  Pairs come out of shared keys in three steps that lose no link between different sets
  and never emit all pairs of a group: every node against the smallest node of each of its keys (the best is
  verified on the full sets); then every node against its nearest partner in another component; at last only keys that
  still hold several components are compared inside.  The latter two compare blocks of bounded size, look at
  pairs across components only, and give each pair once, in the first key that it shares.
* Components by alternating stars (``graph.components``).

Defined results: null or empty text: n_shingles 0, own component.  Null id: n_shingles of its set, component null.
Repeated rows give one result row each; rows that share an id are one document.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskframe.llm.graph import components
from riskframe.llm.store import dropped, written
from riskframe.llm.words import hashes, mixed, releasing, shingles, text_bytes, word_hash_cache

SHINGLE = 5
PERCENT = 75
HASHES = 64
CHUNK = 4
MAX_DISTANCE = 31
#: Members of a key that are compared with each other in one go.
BLOCK = 2048

#: Standard deviations that the share of differing bins may lie above its mean.
SURE = 7
#: Ranges of hash values in the sketch.
BINS = 256
#: Words of the filter of nodes (64 bits each).
FILTER_WORDS = 1 << 18

_A = mixed(np.arange(1, HASHES + 1, dtype=np.uint64)) | np.uint64(1)
_B = mixed(np.arange(1001, 1001 + HASHES, dtype=np.uint64))
_EDGES = np.arange(BINS, dtype=np.uint64) << np.uint64(56)
#: What a node's ``sig`` bytes hold: symbols, size of the set, sketch.
SIG = np.dtype([("symbols", "<u2", HASHES), ("size", "<i8"), ("sketch", "u1", BINS)])


def shingle_set(text: bytes | None, cache) -> np.ndarray:
    words = (text or b"").lower().split()
    return np.unique(shingles(hashes(words, cache, len(words)), SHINGLE))


def signature(items: np.ndarray) -> np.ndarray:
    """Low 16 bits of the mixed minimum of every hash function over the set."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(items), 2048):
        block = items[at : at + 2048, None] * _A
        block += _B
        np.minimum(least, block.min(axis=0), out=least)
    return (mixed(least) & np.uint64(0xFFFF)).astype("<u2")


def sketch(items: np.ndarray) -> np.ndarray:
    """For every bin 0 if empty, else a byte of its smallest member; ``items`` are sorted."""
    at = np.searchsorted(items, _EDGES)
    held = at < np.append(at[1:], len(items))
    out = np.zeros(BINS, dtype=np.uint8)
    out[held] = (mixed(items[at[held]]) % np.uint64(255)).astype(np.uint8) + 1
    return out


def summary(items: np.ndarray) -> bytes:
    out = np.zeros(1, dtype=SIG)
    out["symbols"], out["size"], out["sketch"] = signature(items), len(items), sketch(items)
    return out.tobytes()


def signatures(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=SIG)


def near(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(may the pairs reach the similarity, differing bins, differing symbols) of two arrays of ``SIG``."""
    differs = a["symbols"] != b["symbols"]
    total = a["size"] + b["size"]
    may = differs.sum(axis=1) <= MAX_DISTANCE
    may &= 100 * np.minimum(a["size"], b["size"]) >= PERCENT * np.maximum(a["size"], b["size"])
    bins = (a["sketch"] != b["sketch"]).sum(axis=1)
    may &= bins <= total - 2 * -(-PERCENT * total // (100 + PERCENT))
    used = ((a["sketch"] | b["sketch"]) != 0).sum(axis=1)
    share = 1 - PERCENT / 100
    may &= bins <= share * used + SURE * np.sqrt(share * (1 - share) * used) + 1
    return may, bins, differs


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = word_hash_cache()
    for batch in batches:
        n, lo, hi, sigs = [], [], [], []
        for text in text_bytes(batch.column(1)):
            items = shingle_set(text, cache)
            n.append(len(items))
            sigs.append(summary(items) if len(items) else None)
            digest = xxhash.xxh3_128_intdigest(items.tobytes())
            lo.append(digest & 0x7FFFFFFFFFFFFFFF)
            hi.append(digest >> 65)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(n, pa.int64()), pa.array(lo, pa.int64()), pa.array(hi, pa.int64()), pa.array(sigs, pa.binary())],
            names=["id", "n_shingles", "lo", "hi", "sig"])


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, key): every chunk with one symbol left out, packed into 64 bits without loss."""
    chunks = HASHES // CHUNK
    tag = (np.arange(chunks * CHUNK, dtype=np.uint64) << np.uint64(48)).reshape(chunks, CHUNK)
    for batch in batches:
        for at in range(0, batch.num_rows, 1024):
            part = batch.slice(at, 1024)
            sig = signatures(part.column(1))["symbols"].astype(np.uint64).reshape(-1, chunks, CHUNK)
            keys = np.empty((len(sig), chunks, CHUNK), dtype=np.uint64)
            for out in range(CHUNK):
                packed = tag[:, out]
                for place, k in enumerate(x for x in range(CHUNK) if x != out):
                    packed = packed | (sig[:, :, k] << np.uint64(16 * place))
                keys[:, :, out] = packed
            nodes = np.repeat(part.column(0).to_numpy(zero_copy_only=False), HASHES)
            yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(keys.reshape(-1).view(np.int64))], names=["node", "key"])


def _compared(best: bool):
    """Rows sorted by (key, i, j): pairs (a, b, differing bins) of a group across components that may be near enough; with ``best``
    only the nearest partner of every node of a batch."""

    def pairs(t: pa.Table) -> pa.RecordBatch:
        key, i, j, own, node, comp = (t.column(c).to_numpy() for c in ("key", "i", "j", "own", "node", "component"))
        group = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])]))
        sig = signatures(t.column("sig"))
        tag = (key.view(np.uint64) >> np.uint64(48)).astype(np.int64)
        found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))]
        for lag in range(1, len(group)):
            same = group[lag:] == group[:-lag]
            if not same.any():
                break
            x = np.flatnonzero(same & (comp[lag:] != comp[:-lag]) & ((i[lag:] == j[lag:]) | (own[lag:] != own[:-lag])))
            for at in range(0, len(x), 32768):
                y = x[at : at + 32768]
                may, bins, differs = near(sig[y], sig[y + lag])
                y, bins, differs = y[may], bins[may], differs[may].reshape(-1, HASHES // CHUNK, CHUNK)
                if not best:  # a pair meets in every key that it shares; only the first of them gives it
                    chunk = (differs.sum(axis=2) <= 1).argmax(axis=1)
                    first = tag[y] == chunk * CHUNK + differs[np.arange(len(y)), chunk].argmax(axis=1)
                    y, bins = y[first], bins[first]
                found.append((node[y], node[y + lag], bins.astype(np.int64)))
        a, b, bins = map(np.concatenate, zip(*found, strict=True))
        if best:
            a, b, bins = np.concatenate([a, b]), np.concatenate([b, a]), np.concatenate([bins, bins])
            order = np.lexsort((b, bins, a))
            a, b, bins = a[order], b[order], bins[order]
            top = np.flatnonzero(np.concatenate([[True], a[1:] != a[:-1]])) if len(a) else np.empty(0, np.int64)
            a, b, bins = a[top], b[top], bins[top]
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), pa.array(bins)], names=["a", "b", "bins"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None
        for batch in batches:
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([held, t]) if held is not None else t
            if not t.num_rows:
                continue
            key, i, j = (t.column(c).to_numpy() for c in ("key", "i", "j"))
            last = np.flatnonzero((key != key[-1]) | (i != i[-1]) | (j != j[-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            held = t.slice(cut)
            if cut:
                yield pairs(t.slice(0, cut))
        if held is not None and held.num_rows:
            yield pairs(held)

    return run


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Keep (a, b) whose full sets reach the similarity."""
    cache, last, left = word_hash_cache(), None, None
    for batch in batches:
        keep = []
        for ta, tb in zip(text_bytes(batch.column(2)), text_bytes(batch.column(3)), strict=True):
            if ta != last:
                last, left = ta, shingle_set(ta, cache)
            right = shingle_set(tb, cache)
            if 100 * min(len(left), len(right)) < PERCENT * max(len(left), len(right)):
                keep.append(False)
                continue
            common = len(left) + len(right) - len(np.union1d(left, right))
            keep.append(100 * common >= PERCENT * (len(left) + len(right) - common))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _among(rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """``rows`` whose ``node`` is among ``nodes``.  Most others are left out before the rows are exchanged, by a filter of at most
    ``FILTER_WORDS`` words, which can be broadcast whatever the number of nodes; the join is exact."""
    def marked(df: DataFrame) -> DataFrame:
        return df.withColumn("__word", F.pmod(F.xxhash64("node"), F.lit(FILTER_WORDS))).withColumn(
            "__bit", F.expr("shiftleft(1L, cast(shiftrightunsigned(xxhash64(node), 58) as int))"))

    words = marked(nodes).groupBy("__word").agg(F.expr("bit_or(__bit)").alias("__bits")).withColumnRenamed("__word", "__held")
    may = marked(rows).join(F.broadcast(words), F.expr("__word = __held and __bits & __bit != 0"), "left_semi")
    return may.drop("__word", "__bit").join(nodes, "node", "left_semi")


def _confirm(pairs: DataFrame, texts: DataFrame, name: str) -> DataFrame:
    """Pairs (a, b) that pass the exact test on whole texts."""
    involved = written(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), f"{name}-involved")
    t = written(_among(texts, involved), f"{name}-texts")
    dropped(involved)
    full = (pairs.join(t.select(F.col("node").alias("b"), F.col("text").alias("tb")), "b")
            .join(t.select(F.col("node").alias("a"), F.col("text").alias("ta")), "a").select("a", "b", "ta", "tb"))
    links = written(full.mapInArrow(releasing(_verified), "a long, b long").distinct(), f"{name}-links")
    dropped(t)
    return links


def _near(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(a, b, bins) of candidate pairs that may reach the similarity."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            may, bins, _ = near(signatures(batch.column(2)), signatures(batch.column(3)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(bins)], names=["a", "b", "bins"]).filter(pa.array(may))

    return (pairs.join(nodes.toDF("b", "sb"), "b").join(nodes.toDF("a", "sa"), "a").select("a", "b", "sa", "sb").mapInArrow(releasing(run), "a long, b long, bins long"))


def _merged(label: DataFrame, links: DataFrame) -> DataFrame:
    """(node, component) after more links; ``label`` has the nodes that are linked so far."""
    hops = (links.join(label.toDF("a", "ca"), "a", "left").join(label.toDF("b", "cb"), "b", "left")
            .select(F.coalesce("ca", "a").alias("p"), F.coalesce("cb", "b").alias("q")).where("p != q")
            .select(F.least("p", "q").alias("a"), F.greatest("p", "q").alias("b")))
    second = written(components(hops).toDF("component", "final"), "merged")
    moved = label.join(second, "component", "left").select("node", F.coalesce("final", "component").alias("component"))
    alone = second.join(label.select("node"), second.component == label.node, "left_anti").select(F.col("component").alias("node"), F.col("final").alias("component"))
    return written(moved.union(alone), "components")


def _across(members: DataFrame, label: DataFrame, nodes: DataFrame, best: bool) -> DataFrame:
    """Candidate pairs (a, b) across components, from the keys that hold several."""
    if best:  # a first guess of the nearest partner needs one key of each chunk only; the last step looks at all keys
        members = members.where(F.shiftrightunsigned("key", 48) % CHUNK == 0)
    placed = members.join(label, "node", "left").select("key", "node", "n", F.coalesce("component", "node").alias("component"))
    several = placed.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x != y").select("key")
    blocks = F.ceil(F.col("n") / F.lit(BLOCK)).cast("int")
    spread = (placed.join(several, "key").join(nodes, "node")
              .withColumn("own", F.pmod(F.xxhash64("node"), blocks).cast("int"))
              .withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
              .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own", "node", "component", "sig"))
    found = (spread.repartition("key", "i", "j").sortWithinPartitions("key", "i", "j").mapInArrow(releasing(_compared(best)), "a long, b long, bins long"))
    if best:
        found = found.groupBy("a").agg(F.min(F.struct("bins", "b")).alias("x")).select("a", F.col("x.b").alias("b"))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_shingles, component) for every row of ``docs``; ``component`` is the smallest id reachable by links."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    signed = written(rows.mapInArrow(releasing(_signed), "id long, n_shingles long, lo long, hi long, sig binary"), "signed")

    # One node per distinct set: its smallest id.
    sets = signed.where("n_shingles > 0 and id is not null").groupBy("lo", "hi").agg(F.min("id").alias("node"))
    named = written(signed.select("id", "n_shingles", "lo", "hi").join(sets, ["lo", "hi"], "left").select("id", "n_shingles", "node"), "named")
    # by id, which no group of copies shares; repeated rows of an id with the same set are one
    least = sets.select(F.col("node").alias("id"), "lo", "hi")
    nodes = written(signed.join(least, ["id", "lo", "hi"]).groupBy("id", "lo", "hi").agg(F.first("sig").alias("sig")).select(F.col("id").alias("node"), "sig"), "nodes")
    dropped(signed)
    texts = rows.where("id is not null").select(F.col("id").alias("node"), "text")

    # one exchange of the keys: both figures of a key are taken where its members meet
    group = W.partitionBy("key")
    keys = nodes.mapInArrow(releasing(_keyed), "node long, key long").select("key", "node", F.min("node").over(group).alias("least"), F.count("*").over(group).alias("n"))
    members = written(keys.where("n > 1"), "members")

    stars = members.where("node != least").select(F.col("least").alias("a"), F.col("node").alias("b")).distinct()
    chosen = written(_near(stars, nodes).groupBy("b").agg(F.min(F.struct("bins", "a")).alias("x")).select("x.a", "b"), "chosen")
    label = written(components(_confirm(chosen, texts, "star")), "components")
    dropped(chosen)
    for best in (True, False):
        pairs = written(_across(members, label, nodes, best), "across")
        links = _confirm(pairs, texts, "across")
        dropped(pairs)
        label = _merged(label, links)
    return (named.join(label, "node", "left")
            .select("id", "n_shingles", F.when(F.col("id").isNotNull(), F.coalesce("component", "node", "id")).alias("component")))
