"""Token ids in binary files (2): one shared Zstandard dictionary, one frame per document.

File format (one file per shard; every frame is followed by an empty skippable frame)
    header   skippable frame 0x184D2A5E: "TOKS", version, bytes per id, SHA-256 of the dictionary, the dictionary
    frames   one Zstandard frame per document, in ascending id order: its ids, little-endian, 2 or 4 bytes each
    footer   skippable frame 0x184D2A5F: the offset index, one 40-byte record per document (id, null flag, offset,
             length, first token in the file, number of tokens), then the number of documents
The index finds a short document without reading its neighbours (``read_document``); the dictionary's hash is checked
before any frame is read.  The dictionary is trained on the serialized ids of at most ``SAMPLE`` documents of at most
``SAMPLE_BYTES`` bytes of text (the smallest hashes of the texts); its size is at most ``DICTIONARY``.

Encoding: the tokenizers library encodes words (those of plain letters and marks piece by piece, by its model alone).  A vocabulary that drops white space (as the default one does) cuts at
all ASCII white space, so a document's ids are those of its words one after the other, and a bounded cache of words
saves most of the work; the tests compare with whole-text encoding.  ``END`` is appended to every document.

Defined results: null or empty texts are one end token; null ids come first; repeated ids follow each other, ordered by
a hash of their text; an empty table makes no rows.
"""

from __future__ import annotations

import codecs
import hashlib
import json
import os
import re
import struct
import sys
import zlib
from array import array
from bisect import bisect_left
from collections.abc import Callable, Iterator
from operator import attrgetter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from riskframe.llm.store import EMPTY_FRAME, hash_sample, read_files, skippable, write_frames, written
from riskframe.llm.words import releasing, text_bytes

TOKENIZER = "word_bpe_49k.json"
END = 2
SAMPLE = 2000
SAMPLE_BYTES = 1 << 15
DICTIONARY = 1 << 16
LEVEL = 2
#: Text bytes of a shard.
SHARD_BYTES = 24 << 20
#: Words that one task keeps the ids of.
CACHE_WORDS = 200_000
HEADER, FOOTER = 0x184D2A5E, 0x184D2A5F
# How the default vocabulary normalises and cuts words, and how it writes bytes as characters.  Words of old and
# unaccented or precomposed Latin and Cyrillic characters are cut here, so that a piece is encoded once; all others, and
# all words of other vocabularies, are cut by the library.
_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_KNOWN = ["NFC", "Replace", "Lowercase", ("Split", _PATTERN), ("ByteLevel", None)]
#: The same cut for ``_SIMPLE`` characters, whose numbers are the ten digits.
_CUT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[^\W\d_]+|\d|(?:[^\w\s]|_)+")
_SIMPLE = re.compile("[!-~\u00a1-\u00b1\u00b4-\u00b8\u00ba\u00bb\u00bf-\u012f\u0131-\u0148\u014a-\u024f\u0400-\u045f]+").fullmatch
#: Marks after a word of letters: one piece, whatever their number.  Not "<", which the vocabulary's own tokens start with.
_TAIL_TEXT = "!\"#$%&'()*+,-./:;=>?@[\\]^_`{|}~"
_TAIL = _TAIL_TEXT.encode()
_ID = attrgetter("id")
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [b for b in range(256) if b not in _PRINTED]
_BYTE_LEVEL = "".join(chr(b if b in _PRINTED else 256 + _OTHERS.index(b)) for b in range(256))
_HEAD = "<4sBB32s"
_ENTRY = np.dtype([("id", "<i8"), ("null", "<i4"), ("length", "<u4"), ("offset", "<u8"), ("first", "<u8"), ("tokens", "<u8")])


class _Ids(dict):
    """word -> its ids, made at first sight or taken over from ``old``, the generation before."""

    def __init__(self, make: Callable[[bytes, _Ids], bytes], old: dict[bytes, bytes]):
        super().__init__()
        self.make, self.old = make, old

    def __missing__(self, word: bytes) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            ids = self.make(word, self)
        self[word] = ids
        return ids


class _Vocabulary:
    """Ids of single words as little-endian bytes.  It holds no cache: no cycle may keep one past its task."""

    def __init__(self, tokenizer: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(tokenizer))
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.tokenize = self.tokenizer.model.tokenize
        parts = json.loads(self.tokenizer.to_str())
        self.added = [t["content"].lower() for t in parts["added_tokens"]]
        self.simple = (sys.byteorder == "little" and self.dtype.itemsize == 2 and _KNOWN == [
            *(n["type"] for n in (parts["normalizer"] or {}).get("normalizers", [])), *((t["type"], t.get("pattern", {}).get("Regex")) for t in (parts["pre_tokenizer"] or {}).get("pretokenizers", []))])

    def _single(self, word: str) -> bytes:
        return np.array(self.tokenizer.encode_batch_fast([word], add_special_tokens=False)[0].ids, dtype=self.dtype).tobytes()

    def make(self, word: bytes, known: _Ids) -> bytes:
        """Ids of a word at first sight; its pieces are kept as words of their own."""
        if not self.simple:
            return self._single(word.decode("utf-8", "replace"))
        core = word.rstrip(_TAIL)
        if core.isalpha():
            key = core.lower()
            if key == word:
                return array("H", map(_ID, self.tokenize(key.decode("ascii")))).tobytes()
            return known[key] + known[word[len(core):]] if len(core) < len(word) else known[key]
        text = word.decode("utf-8", "replace")
        letters = text.rstrip(_TAIL_TEXT)
        if letters.isalpha() and _SIMPLE(letters):
            key = letters.lower().encode()
            if key == word:
                return array("H", map(_ID, self.tokenize(codecs.charmap_decode(key, "strict", _BYTE_LEVEL)[0]))).tobytes()
            tail = text[len(letters):].encode()
            return known[key] + known[tail] if tail else known[key]
        if not _SIMPLE(text) or ("<" in text and any(a in text.lower() for a in self.added)):
            return self._single(text)
        pieces = _CUT.findall(text.lower())
        if len(pieces) > 1:
            return b"".join([known[p.encode()] for p in pieces])
        key = pieces[0].encode()
        if key != word:
            return known[key]
        shown = pieces[0] if key.isascii() else codecs.charmap_decode(key, "strict", _BYTE_LEVEL)[0]
        return array("H", map(_ID, self.tokenize(shown))).tobytes()


class Encoder:
    """Ids of whole texts as little-endian bytes."""

    def __init__(self, tokenizer: str):
        vocabulary = _Vocabulary(tokenizer)
        self.dtype = vocabulary.dtype
        self.end = np.array([END], dtype=self.dtype).tobytes()
        self.added_bytes = [a.encode() for a in vocabulary.added]
        self.ids = _Ids(vocabulary.make, {})

    def _words(self, text: bytes) -> list[bytes]:
        """Words of a text.  ASCII letters are lowered as the tokenizer would; not where that could make one of its own tokens,
        or where a mark may join a capital letter to another character than the small one (marks from U+0300 to
        U+037F start with the bytes CC and CD)."""
        low = text.lower()
        if b"\xcc" in text or b"\xcd" in text or any(a in low for a in self.added_bytes):
            return text.split()
        return low.split()

    def encode(self, texts: list[bytes | None]) -> Iterator[bytes]:
        for at in range(0, len(texts), 256):
            if len(self.ids) > CACHE_WORDS:
                self.ids.old = {}
                self.ids = _Ids(self.ids.make, self.ids)
            ids = self.ids.__getitem__
            for t in texts[at : at + 256]:
                yield b"".join(map(ids, self._words(t))) + self.end if t else self.end


def _ids(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(list(encoder.encode(text_bytes(batch.column(0)))), pa.binary())], names=["ids"])

    return releasing(run)


def train_dictionary(rows: DataFrame, tokenizer: str) -> bytes:
    """Dictionary over the serialized ids of a bounded sample of (id, text); empty if there is too little to learn from."""
    few = hash_sample(rows.where(F.octet_length("text") <= SAMPLE_BYTES).select("text"), F.col("text"), SAMPLE)
    samples = [bytes(r["ids"]) for r in few.mapInArrow(_ids(tokenizer), "ids binary").collect()]
    if sum(map(len, samples)) < 8 * DICTIONARY // 4:
        return b""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples, k=256, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def _shards(tokenizer: str, dictionary: bytes):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(tokenizer)
        width = encoder.dtype.itemsize
        zd = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        if zd:
            zd.precompute_compress(level=LEVEL)
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zd)
        header = skippable(struct.pack(_HEAD, b"TOKS", 1, width, hashlib.sha256(dictionary).digest()) + dictionary, HEADER)
        at, first, index = len(header) + len(EMPTY_FRAME), 0, []
        out = [header]
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = text_bytes(batch.column(1))
            for key, raw in zip(keys, encoder.encode(texts), strict=True):
                frame = press.compress(raw)
                index.append((key or 0, key is None, len(frame), at, first, len(raw) // width))
                at, first = at + len(frame) + len(EMPTY_FRAME), first + len(raw) // width
                out.append(frame)
                if len(out) >= 512:
                    yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])
                    out = []
        if index:
            out.append(skippable(np.array(index, dtype=_ENTRY).tobytes() + struct.pack("<Q", len(index)), FOOTER))
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["frame"])

    return releasing(run)


def write_tokens(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", tokenizer: str = TOKENIZER, shard_bytes: int = SHARD_BYTES) -> None:
    """Write every text of ``docs`` to ``path``, shards and documents in ascending id order."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    dictionary = train_dictionary(rows, tokenizer)
    order = [F.col("id").asc_nulls_first(), F.xxhash64("text")]
    shards = rows.repartitionByRange(max(1, -(-total // shard_bytes)), *order).sortWithinPartitions(*order)
    write_frames(shards.mapInArrow(_shards(tokenizer, dictionary), "frame binary"), path)


class TokenFile:
    """One file's bytes: the index, and documents by place or id."""

    def __init__(self, content: bytes):
        self.content = content
        magic, size = struct.unpack_from("<II", content)
        name, version, width, digest = struct.unpack_from(_HEAD, content, 8)
        dictionary = content[8 + struct.calcsize(_HEAD) : 8 + size]
        if magic != HEADER or name != b"TOKS" or version != 1 or hashlib.sha256(dictionary).digest() != digest:
            raise ValueError("not a token file, or its dictionary is not the one that its hash names")
        self.dtype = np.dtype(f"<u{width}")
        end = len(content) - len(EMPTY_FRAME)
        (n,) = struct.unpack_from("<Q", content, end - 8)
        self.index = np.frombuffer(content, dtype=_ENTRY, count=n, offset=end - 8 - n * _ENTRY.itemsize)
        self.reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)

    def document(self, place: int) -> np.ndarray:
        e = self.index[place]
        raw = self.reader.decompress(self.content[int(e["offset"]) : int(e["offset"]) + int(e["length"])])
        return np.frombuffer(raw, dtype=self.dtype)

    def read_document(self, key: int) -> np.ndarray | None:
        """Ids of the document with this id (the first of several), by binary search in the index."""
        skip = int(self.index["null"].sum())
        place = skip + bisect_left(self.index["id"][skip:], key)
        return self.document(place) if place < len(self.index) and self.index["id"][place] == key else None


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            f = TokenFile(content.as_py())
            crc = [zlib.crc32(f.document(i).astype("<u4").tobytes()) for i in range(len(f.index))]
            n = len(f.index)
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * n), pa.array(np.where(f.index["null"] != 0, None, f.index["id"]).tolist(), pa.int64()),
                 pa.array(f.index["first"].astype(np.int64)), pa.array(f.index["tokens"].astype(np.int64)), pa.array(crc, pa.int64())],
                names=["path", "id", "first", "n_tokens", "ids_crc32"])


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """(id, start, n_tokens, ids_crc32) of every document in the files below ``path``; every file is read once."""
    rows = written(read_files(spark, path).mapInArrow(releasing(_digests), "path string, id long, first long, n_tokens long, ids_crc32 long"), "digests")
    # one row per file; file names carry the shard number, so their order is the order of the shards
    before = F.coalesce(F.sum("tokens").over(W.orderBy("path").rowsBetween(W.unboundedPreceding, -1)), F.lit(0).cast("long"))
    shards = rows.groupBy("path").agg(F.sum("n_tokens").alias("tokens")).select("path", before.alias("before"))
    return rows.join(shards, "path").select("id", (F.col("before") + F.col("first")).alias("start"), "n_tokens", "ids_crc32")
