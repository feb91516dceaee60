"""Byte-level BPE against whole-text encoding by the library."""
import hashlib
import random
from collections import Counter

import numpy as np

from riskframe.llm import byte_bpe

DOCS = "doc_id long, text string, ids string, block int, bucket int, data string"


def rows(rng):
    alphabet = ["word", " the", "é", "ü", "Ж", "中", "中文", "\U00010ee7", "\U000323e7", "\u0085", "\x1c", "\x1f", "᠎", "​", "\t", "\n\n", "  ", "12", "٣", "½", "Ⅷ", "'s", "'LL", "don't", "!?", "🙂🙃", "ﬀ", "́", "\xa0"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(1, 60))) for _ in range(60)]
    texts += [None, "", " ", "   \n ", "x" * 3000, " ".join(rng.choice(["alpha", "beta", "gamma"]) for _ in range(20000))]
    out = [(i, t) for i, t in enumerate(texts)] + [(3, texts[3]), (3, texts[4]), (None, "no id"), (None, None)]
    return [(i, t, "x", 1, 2, "y") for i, t in out]


def expected(data):
    e = byte_bpe.encoding_of(byte_bpe.token_table())
    return [(i, e.encode_ordinary(t or ""), (t or "").encode()) for i, t, *_ in data]


def test_equals_whole_texts(spark, monkeypatch):
    data = rows(random.Random(11))
    for block, page, bucket in ((byte_bpe.BLOCK_CHARS, byte_bpe.PAGE, byte_bpe.BUCKET_BYTES), (200, 40, 500)):
        monkeypatch.setattr(byte_bpe, "BLOCK_CHARS", block)
        monkeypatch.setattr(byte_bpe, "PAGE", page)
        monkeypatch.setattr(byte_bpe, "BUCKET_BYTES", bucket)
        docs = spark.createDataFrame(data, DOCS).repartition(3)
        got = byte_bpe.decoded(byte_bpe.encoded(docs)).collect()
        have = Counter((r["id"], tuple(np.frombuffer(r["ids"], dtype="<u4").tolist()), bytes(r["decoded"])) for r in got)
        assert have == Counter((i, tuple(ids), raw) for i, ids, raw in expected(data))
        assert all(r["n_tokens"] == len(r["ids"]) // 4 for r in got)


def test_digests(spark):
    data = rows(random.Random(12))
    got = byte_bpe.digested(spark.createDataFrame(data, DOCS))
    have = Counter((r["id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in got.collect())
    sha = lambda b: hashlib.sha256(b).hexdigest()
    assert have == Counter((i, len(ids), sha(np.array(ids, dtype="<u4").tobytes()), sha(raw)) for i, ids, raw in expected(data))
    assert byte_bpe.digested(spark.createDataFrame([], DOCS)).count() == 0


def test_code_points_cut_as_the_library_cuts():
    """Every code point that the two Unicode tables class differently, and its neighbours, in four contexts."""
    odd = byte_bpe.class_differences()
    pieces, e = byte_bpe.splitter(odd), byte_bpe.encoding_of(byte_bpe.token_table())
    near = {c + d for c in odd for d in (-1, 0, 1)} | set(range(0x300)) | {0x180E, 0x200B, 0x2028, 0x3000, 0xFEFF}
    for c in sorted(near):
        if 0xD800 <= c < 0xE000 or c > 0x10FFFF:
            continue
        for left, right in (("a", "a"), ("1", "1"), ("!", "!"), (" ", " x")):
            t = left + chr(c) + right
            assert sum((e._core_bpe.encode_single_piece(p.encode()) for p in pieces(t)), []) == e.encode_ordinary(t)


def test_decoding_keeps_columns_and_nulls(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, np.array([1, 2], dtype="<u4").tobytes(), "b")], "id long, ids binary, decoded string")
    got = {r["id"]: r["decoded"] for r in byte_bpe.decoded(df).collect()}
    tokens = byte_bpe._bytes_of(byte_bpe.token_table())
    assert got[1] is None and bytes(got[2]) == tokens[1] + tokens[2]
