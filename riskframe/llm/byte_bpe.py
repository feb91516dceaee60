"""Byte-level BPE (11): encoding by a global shuffle of distinct words, decoding by a join with the token-byte table.

Encoding
1. *Explode.* Every text is cut into pre-tokens by the vocabulary's pattern.  Consecutive documents of a partition form a
   block of at most ``BLOCK_CHARS`` characters (one longer document is a block of its own).  A pre-token becomes its
   place in the block's list of distinct words, so positions stay with the documents (pages of ``PAGE`` pre-tokens)
   and only the distinct words of every block travel: a word that a third of all text consists of is one entry a block.
   The cut is written to the shared folder, so later steps see one and the same numbering whatever is lost, bucketed by
   block, so that the pages (most of it) are never shuffled.
2. *Shuffle by word.* The words of all blocks meet in hash buckets; the number of buckets grows with the text
   (``BUCKET_BYTES`` each).  A bucket is read in order and encodes each distinct word once.
3. *Join back and reassemble.* The ids return to their blocks (co-grouped with its pages) and are laid out by position.

What a task holds is one block's words, or one bucket's words, never a share of the corpus.

Pre-tokens must be cut as the tiktoken library cuts them.  Its Unicode tables can be of another version than those of the
``regex`` module: code points that the two class differently (``class_differences``, found by asking both for every code
point) are replaced, for the cut only, by a character of the class that tiktoken sees.  Pieces are encoded by tiktoken.

Decoding joins ids with the table of token bytes; its size is that of the vocabulary file, never of the data.

Defined results: null or empty texts have no ids (and decode to no bytes); null ids are kept; repeated rows give a row
each; an empty table gives none; extra columns are ignored.  Ids outside the table decode as an error.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from riskframe.llm.store import bucketed

RANKS = "byte_bpe_multi_50k.tiktoken"
#: Characters of a block, pre-tokens of a page, and bytes of text for each bucket of words.
BLOCK_CHARS = 24 << 20
PAGE = 1 << 18
BUCKET_BYTES = 16 << 20
#: Stand-ins of the four classes of the pattern: letter, number, white space, anything else.
_CLASSES = {r"\p{L}": "ª", r"\p{N}": "²", r"\s": " "}
_OTHER = "†"


def token_table(ranks: str = RANKS) -> dict[bytes, int]:
    import base64

    import public_tokenizers

    with open(public_tokenizers.path(ranks), "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


def encoding_of(table: dict[bytes, int], pattern: str | None = None):
    import public_tokenizers
    import tiktoken

    return tiktoken.Encoding("byte-bpe", pat_str=pattern or public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={})


def class_differences() -> dict[int, str]:
    """code point -> stand-in of the class that tiktoken sees, where the ``regex`` module sees another one."""
    import regex

    single = {bytes([i]): i for i in range(256)}
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    text = "".join(every)
    theirs, ours = {}, {}
    for name, stand_in in _CLASSES.items():
        e = encoding_of(single, name)  # only what matches is encoded
        theirs |= dict.fromkeys(bytes(e.encode_ordinary(text)).decode("utf-8"), stand_in)
        ours |= dict.fromkeys(regex.findall(name, text), stand_in)
    return {ord(c): theirs.get(c, _OTHER) for c in every if theirs.get(c) != ours.get(c)}


def _ranges(points) -> str:
    """A regular expression's character ranges of these code points."""
    out: list[list[int]] = []
    for c in sorted(points):
        if out and c == out[-1][1] + 1:
            out[-1][1] = c
        else:
            out.append([c, c])
    return "".join(f"\\U{a:08x}-\\U{b:08x}" for a, b in out)


def splitter(differences: dict[int, str], pattern: str | None = None) -> Callable[[str], list[str]]:
    import public_tokenizers
    import regex

    cut = regex.compile(pattern or public_tokenizers.PATTERN)
    if not differences:
        return cut.findall
    # ranges, the astral ones apart, so that ordinary texts are searched by a bitmap and one comparison a character
    low, high = _ranges(c for c in differences if c < 0x10000), _ranges(c for c in differences if c >= 0x10000)
    tests = [re.compile(f"[{low}]")] if low else []
    astral, odd_astral = re.compile("[\U00010000-\U0010ffff]"), re.compile(f"[{high}]") if high else None

    def odd(text: str) -> bool:
        return any(t.search(text) for t in tests) or (odd_astral is not None and astral.search(text) is not None and odd_astral.search(text) is not None)

    def pieces(text: str) -> list[str]:
        if text.isascii() or not odd(text):
            return cut.findall(text)
        return [text[m.start() : m.end()] for m in cut.finditer(text.translate(differences))]

    return pieces


# ------------------------------------------------------------------ packed arrays
def _planes(a: np.ndarray) -> bytes:
    """The four bytes of every number apart: high planes are mostly zero."""
    return np.ascontiguousarray(a, dtype="<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _unplaned(raw: memoryview, n: int) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8, count=4 * n).reshape(4, n).T).view("<u4").reshape(-1)


def pack(press: zstandard.ZstdCompressor, *arrays: np.ndarray, tail: bytes = b"") -> bytes:
    sizes = np.array([len(arrays), *map(len, arrays)], dtype="<u8").tobytes()
    return press.compress(b"".join([sizes, *map(_planes, arrays), tail]))


def unpack(blob: bytes) -> tuple[list[np.ndarray], bytes]:
    raw = memoryview(zstandard.ZstdDecompressor().decompress(blob))
    (k,) = np.frombuffer(raw, dtype="<u8", count=1).tolist()
    sizes, at, out = np.frombuffer(raw, dtype="<u8", count=k, offset=8).tolist(), 8 * (k + 1), []
    for n in sizes:
        out.append(_unplaned(raw[at:], n))
        at += 4 * n
    return out, bytes(raw[at:])


def _ragged(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions starts[i], starts[i] + 1, ... (counts[i] of them), one run after the other."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(starts - (ends - counts), counts) + np.arange(total)


# ------------------------------------------------------------------ 1: explode
class _Places(dict):
    """word -> its place in the order of first sight."""

    def __missing__(self, word):
        place = self[word] = len(self)
        return place


def _exploded(buckets: int, differences: dict[int, str]):
    names = ["block", "bucket", "ids", "data"]

    def rows(block, bucket, ids, data):
        return pa.RecordBatch.from_arrays([pa.array([block] * len(data), pa.int64()), pa.array(bucket, pa.int32()), pa.array(ids, pa.list_(pa.int64())), pa.array(data, pa.binary())], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        pieces, part, number = splitter(differences), TaskContext.get().partitionId(), 0
        places, chars, ids, page, held = _Places(), 0, [], [], 0

        def paged():
            lens = np.array([len(p) for p in page])
            return rows(part << 32 | number, [-1], [list(ids)], [pack(press, lens, np.concatenate(page))])

        def words():
            raw = [w.encode("utf-8") for w in places]
            at = np.fromiter((xxhash.xxh3_64_intdigest(w) % buckets for w in raw), dtype=np.int64, count=len(raw))
            order = np.argsort(at, kind="stable")
            cuts = np.flatnonzero(np.diff(at[order], prepend=-1, append=-1))
            for lo in range(0, len(cuts) - 1, 256):
                bucket, data = [], []
                for a, b in zip(cuts[lo : lo + 256], cuts[lo + 1 : lo + 257], strict=False):
                    here = order[a:b]
                    some = [raw[i] for i in here.tolist()]
                    bucket.append(int(at[here[0]]))
                    data.append(pack(press, np.diff(here, prepend=0), np.array(list(map(len, some))), tail=b"".join(some)))
                yield rows(part << 32 | number, bucket, [None] * len(data), data)

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                text = text.as_py() or ""
                if chars and chars + len(text) > BLOCK_CHARS:
                    if page:
                        yield paged()
                    yield from words()
                    places, chars, ids, page, held, number = _Places(), 0, [], [], 0, number + 1
                found = pieces(text)
                page.append(np.fromiter(map(places.__getitem__, found), dtype=np.uint32, count=len(found)))
                ids.append(key)
                chars, held = chars + len(text), held + len(found)
                if held >= PAGE or len(page) >= 4096:
                    yield paged()
                    ids, page, held = [], [], 0
        if page:
            yield paged()
        yield from words()

    return run


# ------------------------------------------------------------------ 2: each distinct word of a bucket once
def _ids_of_words(table: dict[bytes, int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        piece = encoding_of(table)._core_bpe.encode_single_piece
        known, bucket = {}, None
        for batch in batches:
            out = []
            for here, data in zip(batch.column(1).to_pylist(), batch.column(2), strict=True):
                if here != bucket:
                    known, bucket = {}, here
                (places, lens), text = unpack(data.as_py())
                at, ids = 0, []
                for n in lens.tolist():
                    word = text[at : at + n]
                    found = known.get(word)
                    if found is None:
                        found = known[word] = piece(word)
                    ids.append(found)
                    at += n
                flat = np.fromiter((i for f in ids for i in f), dtype=np.uint32)
                out.append(pack(press, places, np.array(list(map(len, ids))), flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(out, pa.binary())], names=["block", "data"])

    return run


# ------------------------------------------------------------------ 3: reassemble
def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value for each run of ``values`` (ends counted in values)."""
    offsets = np.concatenate([[0], ends]).astype(np.int32) * np.int32(values.dtype.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(values.tobytes())])


def _reassembled(finish: Callable[[np.ndarray, np.ndarray], list[pa.Array]], names: list[str], types: list[pa.DataType]):
    """Pages of a block and the ids of its words -> (id, n_tokens, what ``finish`` makes of the ids and their ends)."""
    schema = pa.schema([("id", pa.int64()), ("n_tokens", pa.int64()), *zip(names, types, strict=True)])

    def run(pages: pa.Table, words: pa.Table) -> pa.Table:
        parts = [unpack(d.as_py())[0] for d in words.column("data")]
        n = sum(len(p[0]) for p in parts)
        starts, counts, flat, at = np.zeros(n, dtype=np.int64), np.zeros(n, dtype=np.int64), [np.empty(0, "<u4")], 0
        for steps, lens, ids in parts:
            places = np.cumsum(steps.astype(np.int64))
            starts[places] = at + np.cumsum(lens) - lens
            counts[places] = lens
            flat.append(ids)
            at += len(ids)
        flat = np.concatenate(flat)
        out = []
        for keys, data in zip(pages.column("ids"), pages.column("data"), strict=True):
            (lens, used), _ = unpack(data.as_py())
            n_ids = counts[used]
            total = np.concatenate([[0], np.cumsum(n_ids)])
            ends = total[np.cumsum(lens.astype(np.int64))]
            ids = flat[_ragged(starts[used], n_ids)]
            out.append(pa.RecordBatch.from_arrays([pa.array(keys.as_py(), pa.int64()), pa.array(np.diff(ends, prepend=0)), *finish(ids, ends)], schema=schema))
        return pa.Table.from_batches(out, schema=schema)

    return run


def _bytes_of(table: dict[bytes, int]) -> list[bytes | None]:
    out: list[bytes | None] = [None] * (max(table.values(), default=-1) + 1)
    for token, i in table.items():
        out[i] = token
    return out


def _encoded(docs: DataFrame, id_col: str, text_col: str, table: dict[bytes, int], finish, names: list[str], types: list[pa.DataType], schema: str) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    pieces = rows.mapInArrow(_exploded(-(-total // BUCKET_BYTES) + 1, class_differences()), "block long, bucket int, ids array<long>, data binary")
    cut = bucketed(pieces, "pieces", "block", -(-total // BLOCK_CHARS) + 1)
    words = cut.where("bucket >= 0").select("block", "bucket", "data").repartition("bucket").sortWithinPartitions("bucket")
    ids = words.mapInArrow(_ids_of_words(table), "block long, data binary")
    pages = cut.where("bucket < 0").select("block", "ids", "data")
    return pages.groupBy("block").cogroup(ids.groupBy("block")).applyInArrow(_reassembled(finish, names, types), schema)


def encoded(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """(id, n_tokens, ids) of every row: ``ids`` are little-endian unsigned 32-bit integers."""
    return _encoded(docs, id_col, text_col, token_table(ranks), lambda ids, ends: [_binary(ids, ends)], ["ids"], [pa.binary()], "id long, n_tokens long, ids binary")


def digested(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ranks: str = RANKS) -> DataFrame:
    """(id, n_tokens, ids_sha256, decoded_sha256) of every row, encoded and decoded without moving the ids."""
    table = token_table(ranks)
    tokens = _bytes_of(table)

    def finish(ids: np.ndarray, ends: np.ndarray) -> list[pa.Array]:
        raw, numbers, start, hashes, texts = memoryview(ids.astype("<u4").tobytes()), ids.tolist(), 0, [], []
        for end in ends.tolist():
            hashes.append(hashlib.sha256(raw[4 * start : 4 * end]).hexdigest())
            texts.append(hashlib.sha256(b"".join(map(tokens.__getitem__, numbers[start:end]))).hexdigest())
            start = end
        return [pa.array(hashes, pa.string()), pa.array(texts, pa.string())]

    return _encoded(docs, id_col, text_col, table, finish, ["ids_sha256", "decoded_sha256"], [pa.string(), pa.string()], "id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def decoded(rows: DataFrame, ids_col: str = "ids", name: str = "decoded", ranks: str = RANKS) -> DataFrame:
    """All columns of ``rows`` and ``name``: the bytes of the ids; null ids decode to null."""
    tokens = _bytes_of(token_table(ranks))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [None if x is None else b"".join(map(tokens.__getitem__, np.frombuffer(x, dtype="<u4").tolist())) for x in batch.column(batch.schema.names.index(ids_col)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.binary())], names=[*batch.schema.names, name])

    base = rows.drop(name) if name in rows.columns else rows
    return base.mapInArrow(run, StructType([*base.schema.fields, StructField(name, BinaryType())]))
