"""Benchmark decontamination (1): template canonicalisation and slot consistency.

Method
------
* Tokens are lower-cased runs of letters or of digits.  The template of a text replaces numbers (digits with inner
  points and commas, English number words), units after a number, and names (runs of title-case words within a sentence,
  one placeholder for each run) by typed placeholders.  A title-case word that starts the text or a sentence may be a name
  or not: there are two templates, one with such words as names and one with them as literal words.
* Windows of ``WINDOW`` tokens are hashed as literal lower-case words (so a change of case alone hides nothing).  Template
  windows begin where the template with opening names has a word or placeholder, and grow past slots until they hold
  ``WINDOW`` of these and ``MIN_LITERAL`` literal words; those that hold a slot are hashed as templates, twice if they hold an opening
  word.  An item shorter than a window is one window of its whole length (``MIN_TOKENS`` tokens at least, shorter items
  identify nothing).
* Document windows pass a bitmap of the benchmark's window hashes, whose size (``BITS`` / 8 bytes) is fixed whatever
  the benchmark holds, then a hash join on the window hash decides.
* Aligned windows (same document position minus item position, in words and placeholders) give slot pairs (item value ->
  document value; names of equally many words give a pair for each word, and a name at the item's edge is compared without the words
  that the document's run has beyond it).  The alignment is consistent if every item value goes to one document value;
  windows of inconsistent alignments count only if no slot changed.  Pairs of opening words are judged for the windows
  that hold such words only, since these need not be names.
* A document holds an item if the windows found cover at least ``SHARE`` of the item's literal windows, or of the places
  where the item has a template window (the ones that can match when slots change; a literal match there counts too).  ``n_windows``,
  ``n_found`` and ``share`` are those of the larger share.

Defined results: null or empty texts hold nothing and null ids are kept as null ids; repeated rows of one id count
as one document; an empty benchmark or corpus gives no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.store import dropped, written
from riskframe.llm.words import WordCache, mixed, releasing, text_bytes

WINDOW = 5
SHARE = 0.75
MIN_LITERAL = 3
MIN_TOKENS = 4
BITS = 1 << 24
GROUP_BYTES = 1 << 18

_TOKEN = re.compile(r"\d+(?:[.,]\d+)*|[^\W\d_]+")
# Number words and units that count as slots.
NUMBER_WORDS = frozenset("two three four five six seven eight nine ten eleven twelve twenty thirty forty fifty hundred thousand million".split())
UNITS = frozenset("mm cm m km inch inches foot feet yard yards mile miles g kg mg lb lbs pound pounds ounce ounces ton tons l ml liter liters litre litres "
                  "s sec second seconds min minute minutes h hour hours day days week weeks month months year years "
                  "dollar dollars euro euros cent cents usd eur percent degree degrees c f v w kw hz ghz mb gb".split())

_RECORD = np.dtype([("hash", "<u8"), ("number", "u1"), ("unit", "u1"), ("title", "u1"), ("ends", "u1")])
_PACK = struct.Struct("<Q4B").pack
ENDS = frozenset(".!?:;")
_NUM, _UNIT, _NAME = (np.uint64(xxhash.xxh3_64_intdigest(t)) for t in (b"\x00number", b"\x00unit", b"\x00name"))
_STEP = np.uint64(0x9E3779B97F4A7C15)


def _chunk(chunk: bytes) -> bytes:
    """Packed records of the tokens of one white-space delimited chunk."""
    text = chunk.decode("utf-8", "replace")
    tokens = _TOKEN.findall(text)
    if not tokens:
        return b""
    ends = text.rstrip("\"')]»”’")[-1:] in ENDS
    out = []
    for i, t in enumerate(tokens, 1):
        low = t.lower()
        out.append(_PACK(xxhash.xxh3_64_intdigest(low), t[0].isdigit() or low in NUMBER_WORDS, low in UNITS, len(t) > 1 and t.istitle(), ends and i == len(tokens)))
    return b"".join(out)


_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _sums(values: np.ndarray) -> np.ndarray:
    """Prefix sums of values times powers of a step: with the inverse powers they give the hash of any window."""
    global _powers
    if len(_powers[0]) <= len(values):
        n = 2 * len(values)
        inverse = np.uint64(pow(int(_STEP), -1, 1 << 64))
        _powers = tuple(np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(n, x, np.uint64))]) for x in (_STEP, inverse))
    out = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _powers[0][: len(values)], out=out[1:])
    return out


def _hashes(sums: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mixed((sums[end] - sums[first]) * _powers[1][first] + (end - first).astype(np.uint64))


class Template:
    """One template of a text: its words and placeholders, the token that each begins with, and which of them are slots."""

    def __init__(self, literal: np.ndarray, number: np.ndarray, unit: np.ndarray, name: np.ndarray, opens: np.ndarray):
        follows = np.zeros(len(literal), dtype=bool)
        follows[1:] = name[1:] & name[:-1] & ~opens[1:]
        self.index = np.cumsum(~follows) - 1
        self.start = np.flatnonzero(~follows)
        self.values = np.select([number, unit, name], [_NUM, _UNIT, _NAME], literal)[self.start]
        self.slot = (number | unit | name)[self.start]
        self.sums = _sums(self.values)
        self.literals = np.concatenate([[0], np.cumsum(~self.slot)])

    def __len__(self) -> int:
        return len(self.start)

    def ends(self, first: np.ndarray, size: int) -> np.ndarray:
        """Ends of the windows from these places; beyond the text if too little is left."""
        return np.maximum(np.searchsorted(self.literals, self.literals[first] + min(MIN_LITERAL, size)), first + size)


class Canonical:
    """Tokens of texts, one text after the other: literal hashes and the two templates.  No window or name crosses texts."""

    def __init__(self, texts: list[bytes | None], cache: WordCache):
        self.texts = [t or b"" for t in texts]
        packed = [b"".join(map(cache.__getitem__, t.split())) for t in self.texts]
        r = np.frombuffer(b"".join(packed), dtype=_RECORD)
        counts = np.array([len(x) // _RECORD.itemsize for x in packed], dtype=np.int64)
        self.begin = np.cumsum(counts) - counts
        self.of = np.repeat(np.arange(len(counts)), counts)
        self.literal = r["hash"].copy()
        head = np.zeros(len(r), dtype=bool)
        head[self.begin[counts > 0]] = True
        number = r["number"] != 0
        after = np.zeros(len(r), dtype=bool)
        after[1:] = number[:-1]
        unit = (r["unit"] != 0) & after & ~head
        opens = head.copy()
        opens[1:] |= r["ends"][:-1] != 0
        name = (r["title"] != 0) & ~number & ~unit
        self.opener = name & opens
        self.named = Template(self.literal, number, unit, name, opens)
        self.plain = Template(self.literal, number, unit, name & ~opens, opens) if self.opener.any() else self.named

    def __len__(self) -> int:
        return len(self.literal)

    def _typed(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Places where a template window begins, and its end."""
        t = self.named
        first = np.arange(max(0, len(t) - size + 1) if size else 0)
        end = t.ends(first, size)
        fine = end <= len(t)
        first, end = first[fine], end[fine]
        fine = self.of[t.start[first]] == self.of[t.start[end - 1]]
        return first[fine], end[fine]

    def windows(self, size: int, typed: int, keep=None) -> tuple[np.ndarray, ...]:
        """(text, place, token, hash, template, first, end) of the windows whose hash ``keep`` finds: literal ones of ``size`` tokens
        (template 0), ones that hold a slot of the template with opening names (1) and without (2).  Places count the former's
        words and placeholders from the text's first; -1 where no template window begins."""
        n, t = len(self), self.named
        first, end = self._typed(typed)
        place = np.full(n, -1)
        place[t.start[first]] = first
        at = np.arange(max(0, n - size + 1) if size else 0)
        at = at[self.of[at] == self.of[at + size - 1]]
        parts = [(place[at], at, _sums(self.literal), at, at + size, 0)]
        held = end - first > t.literals[end] - t.literals[first]
        f, e = first[held], end[held]
        parts.append((f, t.start[f], t.sums, f, e, 1))
        if self.plain is not t and len(first):
            o = self.plain
            a = o.index[t.start[first]]
            z = o.ends(a, typed)
            opened = np.concatenate([[0], np.cumsum(self.opener[o.start])])
            y = np.minimum(z, len(o))
            held = (z <= len(o)) & (opened[y] > opened[a]) & (z - a > o.literals[y] - o.literals[a])
            held &= self.of[o.start[a]] == self.of[o.start[y - 1]]
            f, a, z = first[held], a[held], z[held]
            parts.append((f, t.start[f], o.sums, a, z, 2))
        out = []
        for at, token, sums, a, z, template in parts:
            h = _hashes(sums, a, z)
            hit = keep(h) if keep else np.arange(len(h))
            at, token, h, a, z = at[hit], token[hit], h[hit], a[hit], z[hit]
            of = self.of[token]
            begin = self.begin[of]
            out.append((of, np.where(at < 0, -1, at - t.index[begin]) if len(at) else at, token - begin, h, np.full(len(h), template), a, z))
        return tuple(map(np.concatenate, zip(*out, strict=True)))

    def places(self, typed: int) -> int:
        """Number of places where a template window begins."""
        return len(self._typed(typed)[0])

    def tokens(self, of: int) -> list[str]:
        """Lower-cased tokens of one text (same order as the hashes)."""
        return [t.lower() for c in self.texts[of].split() for t in _TOKEN.findall(c.decode("utf-8", "replace"))]

    def slots(self, of: int, template: int, first: int, end: int, tokens: list[str]) -> tuple[list[str], list[int]]:
        """Values of a window's slots, and of each whether it is an opening name (1), the text's first (2) or last (4) word."""
        if not template:
            return [], []
        t = self.named if template == 1 else self.plain
        begin = int(self.begin[of])
        values, marks = [], []
        for i in range(first, end):
            if t.slot[i]:
                a, z = int(t.start[i]), int(t.start[i + 1]) if i + 1 < len(t) else len(self)
                values.append(" ".join(tokens[a - begin : z - begin]))
                marks.append(int(template == 1 and self.opener[a]) + 2 * (a == begin) + 4 * (z - begin == len(tokens)))
        return values, marks


_WINDOWS = "id long, at long, token long, hash long, size int, template int, slots array<string>, marks array<int>, n_literal long, n_places long"


def _windows(sizes: list[int] | None, bitmap: bytes | None):
    """Window rows of each text; ``sizes`` None: the text's own sizes (benchmark items)."""

    def own(c: Canonical) -> list[tuple[int, int, int]]:
        if len(c) < MIN_TOKENS:
            return []
        literal, typed = min(WINDOW, len(c)), min(WINDOW, len(c.named))
        return [(literal, literal, typed)] if literal == typed else [(literal, literal, 0), (typed, 0, typed if typed >= MIN_TOKENS else 0)]

    def groups(keys: list, texts: list) -> Iterator[tuple[list, list]]:
        """Texts that are handled together: of some ``GROUP_BYTES``, benchmark items one by one."""
        at, held = 0, 0
        for i, t in enumerate(texts):
            held += len(t or b"")
            if sizes is None or held >= GROUP_BYTES or i + 1 == len(texts):
                yield keys[at : i + 1], texts[at : i + 1]
                at, held = i + 1, 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cache = WordCache(_chunk)
        bits = np.frombuffer(bitmap, dtype=np.uint8) if bitmap is not None else None

        def marked(h: np.ndarray) -> np.ndarray:
            place = h >> np.uint64(40)
            return np.flatnonzero(bits[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8) & 1)

        for batch in batches:
            out: list[list] = [[] for _ in range(10)]
            for keys, texts in groups(batch.column(0).to_pylist(), text_bytes(batch.column(1))):
                c = Canonical(texts, cache)
                mine = own(c) if sizes is None else [(s, s, s) for s in sizes]
                n_places = max((c.places(t) for _, _, t in mine), default=0) if sizes is None else 0
                tokens: dict[int, list[str]] = {}
                for size, literal, typed in mine:
                    of, at, token, h, template, first, end = c.windows(literal, typed, marked if bits is not None else None)
                    if not len(at):
                        continue
                    for i in np.unique(of[template > 0]).tolist():
                        if i not in tokens:
                            tokens[i] = c.tokens(i)
                    pairs = [c.slots(*w, tokens.get(w[0], [])) for w in zip(of.tolist(), template.tolist(), first.tolist(), end.tolist(), strict=True)]
                    out[0] += [keys[i] for i in of.tolist()]
                    out[1] += at.tolist()
                    out[2] += token.tolist()
                    out[3] += h.view(np.int64).tolist()
                    out[4] += [size] * len(at)
                    out[5] += template.tolist()
                    out[6] += [v for v, _ in pairs]
                    out[7] += [m for _, m in pairs]
                    out[8] += [len(c) - min(WINDOW, len(c)) + 1] * len(at)
                    out[9] += [n_places] * len(at)
            types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.list_(pa.string()), pa.list_(pa.int32()), pa.int64(), pa.int64())
            names = ["id", "at", "token", "hash", "size", "template", "slots", "marks", "n_literal", "n_places"]
            yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, types, strict=True)], names=names)

    return run


def _slot_pairs(was: str, now: str, mark: int) -> list[tuple[str, str]]:
    """Item value -> document value of one slot: word by word if both have as many words."""
    a, b = was.split(" "), now.split(" ")
    if mark & 2 and len(b) > len(a):
        b = b[-len(a) :]
    elif mark & 4 and len(b) > len(a):
        b = b[: len(a)]
    return list(zip(a, b, strict=True)) if len(a) == len(b) else [(was, now)]


_HITS = "id long, item long, shift long, at long, token long, literal boolean, n_literal long, n_places long, same boolean, opener boolean, pairs array<struct<was:string,now:string,opener:boolean>>"


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hits with their slot pairs: id, item, shift, at, token, literal, n_literal, n_places and slots, item_slots, marks in."""
    pair = pa.struct([("was", pa.string()), ("now", pa.string()), ("opener", pa.bool_())])
    for b in batches:
        same, opener, pairs = [], [], []
        for now, was, marks in zip(*(b.column(i).to_pylist() for i in (8, 9, 10)), strict=True):
            found = [(x, y, bool(m & 1)) for w, d, m in zip(was, now, marks, strict=True) for x, y in _slot_pairs(w, d, m)]
            same.append(all(x == y for x, y, _ in found))
            opener.append(any(o for _, _, o in found))
            pairs.append([dict(zip(("was", "now", "opener"), f, strict=True)) for f in found])
        columns = [*b.columns[:8], pa.array(same, pa.bool_()), pa.array(opener, pa.bool_()), pa.array(pairs, pa.list_(pair))]
        yield pa.RecordBatch.from_arrays(columns, names=[*b.schema.names[:8], "same", "opener", "pairs"])


def _bitmap(hashes: DataFrame) -> bytes:
    """BITS bits that mark the upper bits of every hash; eight partial maps of fixed size reach the driver."""

    def mark(batches):
        bits = np.zeros(BITS // 8, dtype=np.uint8)
        for b in batches:
            place = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64) >> np.uint64(40)
            np.bitwise_or.at(bits, (place >> np.uint64(3)).astype(np.int64), (1 << (place & np.uint64(7))).astype(np.uint8))
        yield pa.RecordBatch.from_arrays([pa.array([bits.tobytes()], pa.binary())], names=["bits"])

    total = np.zeros(BITS // 8, dtype=np.uint8)
    for row in hashes.select("hash").repartition(8).mapInArrow(releasing(mark), "bits binary").toLocalIterator():
        total |= np.frombuffer(bytes(row["bits"]), dtype=np.uint8)
    return total.tobytes()


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", share: float = SHARE) -> DataFrame:
    """(id, item, n_windows, n_found, share, n_slots_changed): one row per document and item that it holds."""
    pair = lambda df, key, text: df.select(F.col(key).cast("long").alias("id"), F.col(text).cast("string").alias("text"))
    items = written(pair(benchmark, item_col, item_text_col).mapInArrow(releasing(_windows(None, None)), _WINDOWS), "items")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    spark = docs.sparkSession
    if not sizes:
        return spark.createDataFrame([], "id long, item long, n_windows long, n_found long, share double, n_slots_changed long")
    found = pair(docs, id_col, text_col).mapInArrow(releasing(_windows(sizes, _bitmap(items))), _WINDOWS)
    joined = found.select("id", "at", "token", "hash", "size", "template", "slots").alias("d").join(items.alias("i"), ["hash", "size"]).where(
        "size(d.slots) = size(i.slots)")
    # written in between: a task that windows and pairs would keep two Python workers, for as long as the executor lives
    met = written(joined.select("d.id", F.col("i.id").alias("item"), (F.col("d.at") - F.col("i.at")).alias("shift"), F.col("i.at").alias("at"),
                                F.col("i.token").alias("token"), (F.col("i.template") == 0).alias("literal"), "i.n_literal", "i.n_places",
                                "d.slots", F.col("i.slots").alias("item_slots"), "i.marks"), "met")
    hits = written(met.mapInArrow(releasing(_paired), _HITS), "hits")
    dropped(met)
    pairs = hits.where("size(pairs) > 0").select("id", "item", "shift", F.explode("pairs").alias("s")).select("id", "item", "shift", "s.*")
    sure = F.when(~F.col("opener"), F.col("now"))
    each = pairs.groupBy("id", "item", "shift", "was").agg(F.min("now").alias("low"), F.max("now").alias("high"), F.min(sure).alias("sure_low"), F.max(sure).alias("sure_high"))
    aligned = each.groupBy("id", "item", "shift").agg(
        F.min(F.col("low") == F.col("high")).alias("all_fit"), F.min(F.col("sure_low").eqNullSafe(F.col("sure_high"))).alias("fit"),
        F.sum((F.col("was") != F.col("low")).cast("long")).alias("all_changed"),
        F.sum(F.coalesce(F.col("was") != F.col("sure_low"), F.lit(False)).cast("long")).alias("changed"))
    key = lambda c: F.col(f"h.{c}").eqNullSafe(F.col(f"s.{c}"))
    valid = (hits.alias("h").join(aligned.alias("s"), key("id") & key("item") & (F.col("h.shift") == F.col("s.shift")), "left")
             .where(F.col("h.same") | F.when(F.col("h.opener"), F.col("s.all_fit")).otherwise(F.col("s.fit"))))
    changed = F.when(F.col("s.all_fit"), F.col("s.all_changed")).when(F.col("s.fit"), F.col("s.changed")).otherwise(0)
    once = valid.groupBy("h.id", "h.item", "h.token").agg(
        F.max("h.n_literal").alias("n_literal"), F.max("h.n_places").alias("n_places"), F.max(F.col("h.literal").cast("long")).alias("literal"),
        F.max((F.col("h.at") >= 0).cast("long")).alias("typed"), F.max(changed).alias("changed"))
    total = once.groupBy("id", "item").agg(F.max("n_literal").alias("n_literal"), F.max("n_places").alias("n_places"), F.sum("literal").alias("literal"),
                                           F.sum("typed").alias("typed"), F.max("changed").alias("n_slots_changed"))
    by_place = F.col("typed") * F.col("n_literal") > F.col("literal") * F.col("n_places")
    return (total.withColumn("n_windows", F.when(by_place & (F.col("n_places") > 0), F.col("n_places")).otherwise(F.col("n_literal")))
            .withColumn("n_found", F.when(by_place & (F.col("n_places") > 0), F.col("typed")).otherwise(F.col("literal")))
            .withColumn("share", F.col("n_found") / F.col("n_windows")).where(F.col("share") >= share)
            .select("id", "item", "n_windows", "n_found", "share", F.coalesce("n_slots_changed", F.lit(0)).cast("long").alias("n_slots_changed")))
