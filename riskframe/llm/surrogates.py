"""PII surrogates (6): keyed, type-consistent replacements.

Every detected entity is replaced by another value of its kind, chosen by a keyed permutation of all values of its form:

* digits of phone, card and identity numbers and of network addresses, letters and digits of mail addresses and the
  vowels and consonants of unlisted names are numbered within their form (same lengths, same punctuation, same case), and the
  number is moved along one cycle of a keyed Feistel permutation.  Hence equal entities get equal surrogates in every
  document (coreference), different ones different surrogates (distinctness), and no entity keeps its value;
* card numbers keep their first digit and their check-digit relation, phone numbers their country code and first-digit class,
  addresses their class, mail addresses their top-level domain, names their script; the gender that a title or a listed given
  name shows is kept (listed names go to listed names of the same script and gender, unlisted ones to unlisted ones).

``collisions`` is the check over the whole corpus: the distinct (kind, entity, surrogate) rows, grouped by surrogate; one
surrogate for two entities, or an unchanged entity, is a collision.  ``replaced`` rewrites texts in one pass, without joins.

Persons are found after a title, or as listed given names with a capitalised word behind them; each word of a name found is then
replaced wherever the text has it, before or after.  Not found: unlisted names without title, titles of scripts other than
Latin and Cyrillic, and mentions in other case.  Mail addresses may have any letters before the "@", but ASCII domains only.

Defined results: null texts stay null, empty ones empty; texts without entities stay as they are; repeated rows are rows of
their own; overlapping candidates: the earlier, then the longer one wins.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

ROUNDS = 8
#: Characters of a label that are one number.
LABEL = 128

# Given names by script and gender, and the titles that show a gender.
NAMES = {
    ("latin", "f"): "Anna Maria Laura Julia Sarah Emma Clara Sofia Marie Alice Elena Lucia Nina Paula Helen Diana Irene Rosa Eva Martha".split(),
    ("latin", "m"): "John Peter Paul Martin Thomas David Daniel Lucas Simon Mark Robert Carlos Miguel Pierre Louis Hans Karl Oscar Victor Hugo".split(),
    ("cyrillic", "f"): "Анна Мария Елена Ольга Наталья Ирина Татьяна Светлана Юлия Вера".split(),
    ("cyrillic", "m"): "Иван Пётр Сергей Алексей Дмитрий Андрей Николай Михаил Павел Олег".split(),
}
TITLES = {"Mr": "m", "Mister": "m", "Sir": "m", "Herr": "m", "Señor": "m", "Sr": "m", "Don": "m", "Monsieur": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Madam": "f",
          "Frau": "f", "Señora": "f", "Sra": "f", "Madame": "f", "Mme": "f", "Mlle": "f", "Dr": "", "Prof": "",
          "Господин": "m", "господин": "m", "Г-н": "m", "г-н": "m", "Госпожа": "f", "госпожа": "f", "Г-жа": "f", "г-жа": "f", "Доктор": "", "доктор": "",
          "Профессор": "", "профессор": ""}
VOWELS = {"latin": "aeiou", "cyrillic": "аеиоуыэюя"}
CONSONANTS = {"latin": "bcdfghjklmnpqrstvwxyz", "cyrillic": "бвгджзклмнпрстфхцчшщ"}

# Numbers: every form begins with a digit, "+" or "(" and has no other characters than a run of these.
_RUN = re.compile(r"[0-9+(][0-9+(). -]*")
NUMBERS = [
    ("address", r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\d|\.\d)"),
    ("identity", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("phone", r"(?<![\d+])\+\d{1,3}[ .-]?\(?\d{2,4}\)?(?:[ .-]?\d{2,4}){2,3}(?!\d)|(?<![\d(])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-])"),
    ("card", r"(?<![\d-])\d{4}(?:(?P<gap>[ -]?)\d{4}(?P=gap)\d{4}(?P=gap)\d{1,7}|[ -]\d{6}[ -]\d{5})(?![\d-])"),
]
_NUMBER = re.compile("|".join(f"(?P<{k}>{p})" for k, p in NUMBERS))
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}")
_WORD = r"\p{Lu}\p{Ll}+"
_GIVEN = r"(?:(?:%s) )(?:(?:%s|\p{Lu}\.) )*%s" % ((_LISTED := "|".join(sorted((n for ns in NAMES.values() for n in ns), key=len, reverse=True))), _LISTED, _WORD)
_PERSON = regex.compile(r"(?:%s)\.? (?:%s|%s(?: %s)?)|%s" % ("|".join(sorted(TITLES, key=len, reverse=True)), _GIVEN, _WORD, _WORD, _GIVEN))
_MENTION = regex.compile(r"(?<![\p{L}\p{M}\p{N}])%s(?![\p{L}\p{M}\p{N}])" % _WORD)


class Permutation:
    """One keyed cycle through range(n): x -> the number after it, in the order of a Feistel permutation."""

    def __init__(self, key: bytes):
        self.key = key

    def _round(self, i: int, tweak: str, x: int, bits: int) -> int:
        h = hashlib.blake2b(f"{i}:{tweak}:{x}".encode(), key=self.key[:64], digest_size=-(-bits // 8) or 1).digest()
        return int.from_bytes(h, "big") & ((1 << bits) - 1)

    def _move(self, x: int, n: int, tweak: str, back: bool) -> int:
        bits = max(1, ((n - 1).bit_length() + 1) // 2)
        mask = (1 << bits) - 1
        while True:
            a, b = x >> bits, x & mask
            for i in reversed(range(ROUNDS)) if back else range(ROUNDS):
                a, b = (b ^ self._round(i, tweak, a, bits), a) if back else (b, a ^ self._round(i, tweak, b, bits))
            x = a << bits | b
            if x < n:
                return x

    def after(self, x: int, n: int, tweak: str) -> int:
        if n < 2:
            return x
        return self._move((self._move(x, n, tweak, False) + 1) % n, n, tweak, True)


def _in_alphabets(p: Permutation, value: str, alphabets: list[str], tweak: str, fine: Callable[[str], bool] = lambda _: True) -> str:
    """The value after ``value`` among all strings whose i-th character is from the i-th alphabet."""
    n, x = 1, 0
    for c, a in zip(value, alphabets, strict=True):
        x, n = x * len(a) + a.index(c), n * len(a)
    while True:
        x = p.after(x, n, tweak)
        y, out = x, []
        for a in reversed(alphabets):
            y, r = divmod(y, len(a))
            out.append(a[r])
        new = "".join(reversed(out))
        if fine(new):
            return new


_DIGITS = "0123456789"
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


def _digits(p: Permutation, digits: str, tweak: str) -> str:
    """Keeps the class of the first digit (0, 1, 2-9)."""
    first = digits[0] if digits[0] in "01" else "23456789"
    return _in_alphabets(p, digits, [first] + [_DIGITS] * (len(digits) - 1), f"{tweak}:{len(digits)}:{first[0]}")


def _refill(form: str, digits: str) -> str:
    it = iter(digits)
    return "".join(next(it) if c.isdigit() else c for c in form)


def _lower(value: str) -> str:
    """Letter by letter, so that lengths stay."""
    return value.lower() if value.isascii() else "".join(low if len(low := c.lower()) == 1 else c for c in value)


@lru_cache(maxsize=4096)
def _alphabet(c: str) -> str:
    """ASCII letters or digits; for other letters and digits those of their block of 64 code points whose case can be changed and back."""
    if c.isascii():
        return _LETTERS if c.isalpha() else _DIGITS if c.isdigit() else c
    same = [x for x in map(chr, range(ord(c) & ~63, (ord(c) | 63) + 1))
            if (x.isalpha(), x.isdigit()) == (c.isalpha(), c.isdigit()) and x.lower() == x and len(x.upper()) == 1 and x.upper().lower() == x]
    return "".join(same) if c.isalnum() and c in same else c


def _label(p: Permutation, label: str, tweak: str) -> str:
    if len(label) > LABEL:  # long ones piece by piece
        return "".join(_label(p, label[i : i + LABEL], f"{tweak}:{i}:{len(label)}") for i in range(0, len(label), LABEL))
    kinds = [_alphabet(c) for c in label]
    form = "".join("0" if k is _DIGITS else k[0] for k in kinds)
    return _in_alphabets(p, label, kinds, f"{tweak}:{form}")


def luhn(digits: str) -> int:
    """Check digit of the digits before it."""
    total = sum(d if i % 2 else (2 * d - 9 if d > 4 else 2 * d) for i, d in enumerate(map(int, reversed(digits))))
    return -total % 10


def canonical(kind: str, value: str) -> str:
    """What makes two mentions the same entity."""
    if kind in ("phone", "card", "identity"):
        d = "".join(c for c in value if c.isdigit())
        return d[1:] if kind == "phone" and len(d) == 11 and d[0] == "1" else d
    return _lower(value) if kind == "email" else value


def _script(name: str) -> str:
    return "cyrillic" if "Ѐ" <= name[0] <= "ӿ" else "latin"


def _name(p: Permutation, name: str, gender: str) -> str:
    script = _script(name)
    for g in ("f", "m"):
        names = NAMES[script, g]
        if name in names:
            return names[p.after(names.index(name), len(names), f"name:{script}:{g}")]
    listed = {x.lower() for g in ("f", "m") for x in NAMES[script, g]}
    low = name.lower()
    kinds = [next((a for a in (VOWELS[script], CONSONANTS[script]) if c in a), c) for c in low]
    if script == "latin" and low[-1] == "a":
        kinds[-1] = "a"  # a feminine ending stays
    if all(len(k) == 1 for k in kinds):  # other scripts
        kinds = ["".join(x for x in _alphabet(c) if x not in VOWELS[script] + CONSONANTS[script]) or c for c in low]
    form = "".join("v" if k == VOWELS[script] else "c" if k == CONSONANTS[script] else k[0] for k in kinds)
    if all(len(k) == 1 for k in kinds):
        return name
    return _in_alphabets(p, low, kinds, f"name:{script}:{form}", lambda x: x not in listed).capitalize()


def surrogate(p: Permutation, kind: str, value: str) -> str:
    if kind == "email":
        local, _, domain = _lower(value).partition("@")
        labels = domain.split(".")
        new = _label(p, local, "local") + "@" + ".".join([*(_label(p, x, "domain") for x in labels[:-1]), labels[-1]])
        return "".join(n.upper() if o.isupper() else n for o, n in zip(value, new, strict=True))
    if kind == "address":
        a = [int(x) for x in value.split(".")]
        low, high = next((x, y) for x, y in ((0, 0), (1, 9), (10, 10), (11, 126), (127, 127), (128, 223), (224, 255)) if x <= a[0] <= y)
        x = p.after(((a[0] - low) << 24) | a[1] << 16 | a[2] << 8 | a[3], (high - low + 1) << 24, f"address:{low}")
        return f"{low + (x >> 24)}.{x >> 16 & 255}.{x >> 8 & 255}.{x & 255}"
    if kind == "person":
        first, *names = value.split(" ")
        gender = TITLES.get(first.rstrip("."))
        return " ".join([first if gender is not None and names else _name(p, first, ""), *(_name(p, n, gender or "") for n in names)])
    digits = "".join(c for c in value if c.isdigit())
    if kind == "card":
        off = (int(digits[-1]) - luhn(digits[:-1])) % 10
        body = digits[0] + _in_alphabets(p, digits[1:-1], [_DIGITS] * (len(digits) - 2), f"card:{len(digits)}:{digits[0]}:{off}")
        return _refill(value, body + str((luhn(body) + off) % 10))
    if kind == "phone":
        own = canonical(kind, value)
        code = digits[: len(digits) - len(own)]
        return _refill(value, code + _digits(p, own, "phone"))
    return _refill(value, _digits(p, digits, "identity"))


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, value) of the entities of one text."""
    found = []
    for run in _RUN.finditer(text):
        if sum(map(str.isdigit, run[0])) >= 4:
            found += [(m.start(), m.end(), next(k for k, _ in NUMBERS if m[k]), m[0]) for m in _NUMBER.finditer(text, run.start(), run.end())]
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        if domain and at and text[at - 1].isalnum():
            start = at
            while start and ((c := text[start - 1]).isalnum() or c in "._%+-" or not c.isascii() and unicodedata.category(c)[0] == "M"):
                start -= 1
            found.append((start, domain.end(), "email", text[start : domain.end()]))
        at = text.find("@", at + 1)
    people = [(m.start(), m.end(), "person", m[0]) for m in _PERSON.finditer(text) if not text[max(0, m.start() - 1) : m.start()].isalnum()]
    found += people
    if names := {n for e in people for i, n in enumerate(e[3].split(" ")) if not n.endswith(".") and (i or n not in TITLES)}:
        found += [(m.start(), m.end(), "person", m[0]) for m in _MENTION.finditer(text) if m[0] in names]
    out, end = [], 0
    for e in sorted(found, key=lambda e: (e[0], -e[1])):
        if e[0] >= end:
            out.append(e)
            end = e[1]
    return out


def rewrite(text: str, p: Permutation) -> tuple[str, list[tuple[str, str, str]]]:
    """The text with surrogates, and (kind, entity, surrogate) of every replacement."""
    out, at, done = [], 0, []
    for a, b, kind, value in entities(text):
        new = surrogate(p, kind, value)
        out += [text[at:a], new]
        at = b
        done.append((kind, canonical(kind, value), canonical(kind, new)))
    return ("".join([*out, text[at:]]), done) if done else (text, done)


def replaced(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` with surrogates in the text, and ``entities``: what was replaced (kind, entity, surrogate)."""
    base = docs.drop("entities").withColumn(text_col, F.col(text_col).cast("string"))
    schema = base.withColumn("entities", F.lit(None).cast("array<struct<kind:string,entity:string,surrogate:string>>")).schema
    item = pa.struct([("kind", pa.string()), ("entity", pa.string()), ("surrogate", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = Permutation(key.encode())
        for batch in batches:
            at = batch.schema.names.index(text_col)
            texts, found = [], []
            for text in batch.column(at).to_pylist():
                new, done = rewrite(text, p) if text else (text, [])
                texts.append(new)
                found.append([dict(zip(("kind", "entity", "surrogate"), d, strict=True)) for d in done])
            columns = [*batch.columns]
            columns[at] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.list_(item))], names=[*batch.schema.names, "entities"])

    return base.mapInArrow(run, schema)


def collisions(found: DataFrame) -> DataFrame:
    """(kind, surrogate, entities) that break distinctness: ``found`` has rows of ``entities``."""
    pairs = found.select(F.explode("entities").alias("e")).select("e.*").distinct()
    return (pairs.groupBy("kind", "surrogate").agg(F.count("*").alias("entities"), F.max((F.col("entity") == F.col("surrogate")).cast("int")).alias("same"))
            .where("entities > 1 or same = 1"))
