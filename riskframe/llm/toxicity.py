"""Toxicity (4): a factorization machine over hashed terms.

Terms of a text are its lower-cased words and, for words longer than five letters, their first five letters (so an
inflected insult shares a term with its stem), hashed to 2**30.  The model is

    score = sigmoid(w0 + sum_i w_i x_i + sum_{i<j} <v_i, v_j> x_i x_j),    x_i = 1 if the text has term i

so that a pair of terms (an insult next to a group mention) has a weight of its own, which additive weights lack.

Training reads labelled rows only: per class the ``SAMPLE`` rows that come first in a hash order of their ids (the
documented bound of the sample).  Terms are screened on that sample by a two-proportion z test (at most
``MAX_TERMS`` stay), then the machine is fitted by Adam on mini-batches in one task; the fitted table (at most
``MAX_TERMS`` rows of 1 + ``RANK`` numbers) is what scoring tasks get.  Scoring reads every whole text.

Defined results: null or empty texts get the score of a text without terms; without labelled rows of both classes
the score is the smoothed share of positives for every text (0.5 without any labels).  Labels other than 0 and 1
are ignored; repeated labels of an id count once, as toxic if any says so.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskframe.llm.words import WordCache, releasing, text_bytes

SAMPLE = 6000
MAX_TERMS = 1024
RANK = 8
MIN_Z = 5.0
EPOCHS = 24
BATCH = 64
RATE = 0.03
DECAY = 1e-5
THRESHOLD = 0.7
PREFIX = 5

_TOKEN = re.compile(r"[^\W_]+")


def chunk_terms(chunk: bytes) -> tuple[int, ...]:
    """Hashed terms of one white-space delimited chunk."""
    out = []
    for word in _TOKEN.findall(chunk.decode("utf-8", "replace").lower()):
        out.append(xxhash.xxh32_intdigest(word.encode(), 1) >> 2)
        if len(word) > PREFIX:
            out.append(xxhash.xxh32_intdigest(word[:PREFIX].encode(), 2) >> 2)
    return tuple(out)


@dataclass
class FactorizationMachine:
    bias: float = 0.0
    terms: dict[int, int] = field(default_factory=dict)
    linear: np.ndarray = field(default_factory=lambda: np.zeros(0))
    factors: np.ndarray = field(default_factory=lambda: np.zeros((0, RANK)))

    def score(self, found: list[int]) -> float:
        """``found``: positions of the distinct terms of a text."""
        v = self.factors[found]
        z = self.bias + self.linear[found].sum() + 0.5 * float((v.sum(axis=0) ** 2 - (v**2).sum(axis=0)).sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(z, -30.0, 30.0))))


def is_held_out(id_col: str | Column) -> Column:
    c = F.col(id_col) if isinstance(id_col, str) else id_col
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def _extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    cache = WordCache(chunk_terms)
    for batch in batches:
        terms = [sorted({t for w in set((x or b"").split()) for t in cache[w]}) for x in text_bytes(batch.column(2))]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(terms, pa.list_(pa.int32()))], names=["id", "y", "terms"])


def fit(y: np.ndarray, docs: list[np.ndarray]) -> tuple[np.ndarray, float, np.ndarray, np.ndarray]:
    """(kept terms, bias, linear weights, factors) from binary labels and the sorted distinct terms of each text."""
    n1, n0 = int(y.sum()), int(len(y) - y.sum())
    flat = np.concatenate([*docs, np.empty(0, dtype=np.int32)])
    owner = np.repeat(np.arange(len(docs)), [len(d) for d in docs])
    terms, place = np.unique(flat, return_inverse=True)
    pos = np.bincount(place, weights=y[owner], minlength=len(terms))
    both = np.bincount(place, minlength=len(terms))
    p = both / len(y)
    z = (pos / n1 - (both - pos) / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n1 + 1 / n0))
    order = np.lexsort((terms, -np.abs(z)))[:MAX_TERMS]
    kept = np.sort(order[np.abs(z[order]) >= MIN_Z])
    column = np.full(len(terms), -1)
    column[kept] = np.arange(len(kept))
    used = column[place] >= 0
    x = np.zeros((len(y), len(kept)), dtype=np.float32)
    x[owner[used], column[place][used]] = 1.0

    rng = np.random.default_rng(7)
    theta = {"b": np.zeros(1), "w": np.zeros(len(kept)), "v": rng.normal(0, 0.05, (len(kept), RANK))}
    m = {k: np.zeros_like(a) for k, a in theta.items()}
    s = {k: np.zeros_like(a) for k, a in theta.items()}
    step = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(y))
        for at in range(0, len(y), BATCH):
            rows = order[at : at + BATCH]
            xb, step = x[rows], step + 1
            sv = xb @ theta["v"]
            logit = theta["b"][0] + xb @ theta["w"] + 0.5 * (sv**2 - xb @ theta["v"] ** 2).sum(axis=1)
            g = (1 / (1 + np.exp(-np.clip(logit, -30, 30))) - y[rows]) / len(rows)
            gw = xb.T @ g
            grad = {"b": np.array([g.sum()]), "w": gw + DECAY * theta["w"], "v": xb.T @ (g[:, None] * sv) - gw[:, None] * theta["v"] + DECAY * theta["v"]}
            for k, a in theta.items():
                m[k] = 0.9 * m[k] + 0.1 * grad[k]
                s[k] = 0.999 * s[k] + 0.001 * grad[k] ** 2
                a -= RATE * (m[k] / (1 - 0.9**step)) / (np.sqrt(s[k] / (1 - 0.999**step)) + 1e-8)
    return terms[kept], float(theta["b"][0]), theta["w"], theta["v"]


def _fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = sorted((r for b in batches for r in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), (np.array(t, dtype=np.int32) for t in b.column(2).to_pylist()), strict=True)), key=lambda r: r[:2])
    y = np.array([r[1] for r in rows], dtype=np.float64)
    if not 0 < y.sum() < len(y):
        return
    terms, bias, w, v = fit(y, [r[2] for r in rows])
    yield pa.RecordBatch.from_arrays(
        [pa.array([-1, *terms.tolist()], pa.int32()), pa.array([bias, *w.tolist()]), pa.array([[0.0] * RANK, *v.tolist()], pa.list_(pa.float64()))],
        names=["term", "w", "v"])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", sample: int = SAMPLE) -> FactorizationMachine:
    """Fit on at most ``sample`` labelled rows of each class; ``labels`` must hold training rows only."""
    marked = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("y"))
              .where("id is not null and y in (0, 1)").groupBy("id").agg(F.max("y").alias("y")))
    n = {r["y"]: r["n"] for r in marked.groupBy("y").agg(F.count("*").alias("n")).collect()}
    pos, neg = n.get(1, 0), n.get(0, 0)
    prior = float(np.log((pos + 1) / (neg + 1)))
    if not pos or not neg:
        return FactorizationMachine(bias=prior)
    ranked = marked.orderBy(F.xxhash64("id"), "id")
    chosen = ranked.where("y = 1").limit(sample).union(ranked.where("y = 0").limit(sample))
    # at most 2 * sample rows of 12 bytes
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
            .join(F.broadcast(chosen), "id").select("id", "y", "text").mapInArrow(releasing(_extracted), "id long, y int, terms array<int>"))
    table = rows.repartition(1).mapInArrow(releasing(_fitted), "term int, w double, v array<double>").collect()
    if not table:
        return FactorizationMachine(bias=prior)
    bias = next(r["w"] for r in table if r["term"] < 0)
    table = [r for r in table if r["term"] >= 0]
    return FactorizationMachine(bias, {r["term"]: i for i, r in enumerate(table)}, np.array([r["w"] for r in table]), np.array([r["v"] for r in table]).reshape(-1, RANK))


def scored(docs: DataFrame, model: FactorizationMachine, text_col: str = "text", name: str = "score") -> DataFrame:
    """All columns of ``docs`` and ``name``: the probability of label 1."""
    shared = model

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = shared.terms
        cache = WordCache(lambda w: tuple(known[t] for t in chunk_terms(w) if t in known))
        for batch in batches:
            at = batch.schema.names.index(text_col)
            out = []
            for text in text_bytes(batch.column(at)):
                found = set()
                for hit in filter(None, map(cache.__getitem__, (text or b"").split())):
                    found.update(hit)
                out.append(shared.score(sorted(found)))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], names=[*batch.schema.names, name])

    kept = docs.drop(name) if name in docs.columns else docs
    kept = kept.withColumn(text_col, F.col(text_col).cast("string"))
    return kept.mapInArrow(releasing(run), kept.withColumn(name, F.lit(0.0)).schema)
