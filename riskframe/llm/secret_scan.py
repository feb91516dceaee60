"""Secret scan (9): fixed patterns, and character Markov models of random strings against ordinary identifiers.

Base spans are the matches of three fixed patterns.  The method adds spans: tokens of at least ``MIN_LENGTH`` characters with
letters and digits, outside base spans, whose log-likelihood under a character Markov model of random strings exceeds
that under a model of ordinary tokens by ``MARGIN`` nats a character at least.

Training is by labelled samples from the corpus itself: the secret parts of base matches are the random strings, all other
token characters of all texts the ordinary ones.  Every task counts character pairs of its texts (two tables of fixed size);
the tables are summed, so the counts cover every text and the driver gets two small matrices.  The random model is mixed
half and half with the uniform distribution, since base matches show only part of what random strings may hold.

Spans are in code points, end exclusive, and cover the whole match.  Defined results: null or empty texts have no spans (the
digest of the empty string); without any base match the random model is uniform; repeated rows are rows of their own.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.words import text_bytes

MIN_LENGTH = 16
MARGIN = 0.9
#: Weight of the overall frequencies in a context, in characters.
PRIOR = 500

# The base patterns, in the order in which kinds are listed.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
KINDS = ("assign", "access", "hex", "markov")
KEYWORDS = ("password", "passwd", "secret", "token", "api")

_assign = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_access = re.compile(ACCESS)
_hex = re.compile(r"[0-9a-f]{%d,}" % HEX_LEAST)  # maximal runs, as the pattern with a length test gives them
_token = re.compile(r"[A-Za-z0-9+/_=-]+")

SYMBOLS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
N = len(SYMBOLS) + 1  # the last class is every other byte
_CLASS = np.full(256, N - 1, dtype=np.int64)
_CLASS[np.frombuffer(SYMBOLS, dtype=np.uint8)] = np.arange(N - 1)
_IS_HEX = np.zeros(256, dtype=np.int32)
_IS_HEX[np.frombuffer(b"0123456789abcdef", dtype=np.uint8)] = 1


def _may_hold_hex(raw: bytes) -> bool:
    """A run of 32 hex bytes covers eight neighbours of every fourth byte."""
    every = _IS_HEX[np.frombuffer(raw, dtype=np.uint8)[::4]]
    if len(every) < HEX_LEAST // 4:
        return False
    c = np.concatenate([[0], np.cumsum(every)])
    step = HEX_LEAST // 4
    return bool((c[step:] - c[:-step] == step).any())


def base_spans(raw: bytes, text: str | None = None) -> list[tuple[int, int, int, str]]:
    """(start, kind number, end, secret part) of the base matches of one text, in order."""
    low = raw.lower()
    out: list[tuple[int, int, int, str]] = []
    assign = any(k.encode() in low for k in KEYWORDS)
    access = b"AKIA" in raw
    hexes = _may_hold_hex(raw)
    if not (assign or access or hexes):
        return out
    text = raw.decode("utf-8", "replace") if text is None else text
    if assign:
        out += [(m.start(), 0, m.end(), m[2]) for m in _assign.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if access:
        out += [(m.start(), 1, m.end(), m[0]) for m in _access.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    if hexes:
        out += [(m.start(), 2, m.end(), m[0]) for m in _hex.finditer(text)]
    return sorted(out)


def pair_counts(raw: bytes) -> np.ndarray:
    """N x N counts of neighbouring characters (the text begins and ends with a character of the last class)."""
    c = _CLASS[np.frombuffer(b"\n" + raw + b"\n", dtype=np.uint8)]
    return np.bincount(c[:-1] * N + c[1:], minlength=N * N)


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    every, random = np.zeros(N * N, dtype=np.int64), np.zeros(N * N, dtype=np.int64)
    for batch in batches:
        texts = [t for t in text_bytes(batch.column(0)) if t]
        secrets = [s[3].encode() for t in texts for s in base_spans(t)]
        for some, total in ((texts, every), (secrets, random)):
            joined, size = [], 0
            for t in some:
                joined.append(t)
                size += len(t)
                if size > 1 << 22:
                    total += pair_counts(b"\n".join(joined))
                    joined, size = [], 0
            if joined:
                total += pair_counts(b"\n".join(joined))
    kind = [0] * (N * N) + [1] * (N * N)
    yield pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array([*range(N * N)] * 2, pa.int32()), pa.array(np.concatenate([every, random]))], names=["kind", "pair", "n"])


def train(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """N x N log-likelihood ratios (random over ordinary) of the next character given the one before."""
    rows = docs.select(F.col(text_col).cast("string")).mapInArrow(_counted, "kind int, pair int, n long")
    counts = np.zeros((2, N * N))
    for r in rows.groupBy("kind", "pair").agg(F.sum("n").alias("n")).where("n > 0").collect():
        counts[r["kind"], r["pair"]] = r["n"]
    every, random = counts.reshape(2, N, N)
    ordinary = np.maximum(every - random, 0)

    def conditional(c: np.ndarray) -> np.ndarray:
        """Contexts seen seldom lean on how often a character comes at all, so that a stray secret among the ordinary
        tokens does not vouch for itself."""
        c = c[:, : N - 1]
        overall = (c.sum(axis=0) + 0.5) / (c.sum() + 0.5 * (N - 1))
        return (c + PRIOR * overall) / (c.sum(axis=1, keepdims=True) + PRIOR)

    seen = 0.5 if random.sum() else 0.0
    mixture = seen * conditional(random) + (1 - seen) / (N - 1)
    return np.log(mixture) - np.log(conditional(ordinary))


def added_spans(text: str, base: list[tuple[int, int, int, str]], ratio: np.ndarray) -> list[tuple[int, int, int, str]]:
    """Spans of tokens that read like random strings."""
    out, at = [], 0
    for word in text.split():
        at = text.index(word, at)
        if len(word) >= MIN_LENGTH:
            for m in _token.finditer(word):
                token = m[0]
                if len(token) < MIN_LENGTH or token.isalpha() or not (any(c.isdigit() for c in token) and any(c.isalpha() for c in token)):
                    continue
                a, b = at + m.start(), at + m.end()
                if any(a < end and start < b for start, _, end, _ in base):
                    continue
                c = _CLASS[np.frombuffer(b"\n" + token.encode(), dtype=np.uint8)]
                if ratio[c[:-1], c[1:]].sum() >= MARGIN * len(token):
                    out.append((a, 3, b, token))
        at += len(word)
    return out


def scanned(docs: DataFrame, ratio: np.ndarray, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and ``secrets``: the spans (kind, start, end, value) by start, then kind as listed."""
    types = "array<struct<kind:string,start:long,end:long,value:string>>"
    base = docs.drop("secrets").withColumn(text_col, F.col(text_col).cast("string"))
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.names.index(text_col)
            out = []
            for raw in text_bytes(batch.column(at)):
                if not raw:
                    out.append([])
                    continue
                spans = base_spans(raw)
                if any(len(w) >= MIN_LENGTH and not w.isalpha() for w in raw.split()):
                    text = raw.decode("utf-8", "replace")
                    spans = sorted(spans + added_spans(text, spans, ratio))
                out.append([{"kind": KINDS[k], "start": a, "end": b, "value": v} for a, k, b, v in spans])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.list_(span))], names=[*batch.schema.names, "secrets"])

    return base.mapInArrow(run, base.withColumn("secrets", F.lit(None).cast(types)).schema)


def joined(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
