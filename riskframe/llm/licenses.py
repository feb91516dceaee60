"""License scan (10): a trained paragraph classifier, confirmed by comparison with templates.

Paragraphs are the lines of a text, and runs of consecutive lines (none without words) joined with white space, since published
notices are wrapped: a run is reported if no line or shorter run within it is reported as the same family, and goes on while
more of the template is found.  A run ends with the first line by which it holds as many words after its first line as the
longest template.  A multinomial logistic regression over sparse word 1-, 2- and 3-grams gives each one
probabilities of the licence families and of ``unknown``.  It is trained on paragraphs made from the templates (each template,
parts of it, and both between words of ordinary paragraphs) and, as the unknown class, on at most ``SAMPLE`` ordinary paragraphs
of at most ``SAMPLE_BYTES`` bytes of the corpus itself (first in a hash order; paragraphs that hold most of a template, or are
mostly a part of one, are left out).  Only n-grams of the templates and the most frequent ones of the sample are features.

The unknown class is calibrated on a third of the training paragraphs that the fit does not see: a temperature scales the
logits so that their probabilities are the likeliest there.  A paragraph is reported if its most likely class is a family, with a probability of at
least ``LEAST``, and if some template of that family is contained in it: at least ``CONTAINED`` of the template's 3-word shingles
(a template of fewer words as a whole).

Defined results: null or empty texts and blank paragraphs give no rows; null ids are reported as null; repeated rows repeat
their rows; an empty corpus still trains (on templates only) and gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskframe.llm.store import hash_sample
from riskframe.llm.words import text_bytes

SAMPLE = 3000
SAMPLE_BYTES = 2000
LEAST = 0.5
CONTAINED = 0.7
EPOCHS = 150
DECAY = 1e-4
MAX_COMMON = 1000

# Opening or typical sentences of well-known licence notices, by family.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS",
    ],
    "mit": [
        "Released under the MIT License",
        "Licensed under the MIT License",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3",
        "it under the terms of the GNU General Public License as published by the Free Software Foundation",
        "You should have received a copy of the GNU General Public License along with this program",
    ],
    "lgpl": [
        "it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation",
        "Licensed under the GNU Lesser General Public License",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
        "Licensed under the BSD 3-Clause License",
        "Released under the BSD License",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0",
    ],
    "cc-by": ["This work is licensed under a Creative Commons Attribution 4.0 International License", "Licensed under CC BY 4.0"],
    "cc-by-sa": ["This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License", "Licensed under CC BY-SA 4.0"],
    "cc-by-nc": ["This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License", "Licensed under CC BY-NC 4.0"],
    "public-domain": ["This is free and unencumbered software released into the public domain", "This work is in the public domain"],
    "all-rights-reserved": ["All rights reserved", "Copyright reserved by the author, all rights reserved"],
}
FAMILIES = ["unknown", *TEMPLATES]
_WORD = re.compile(r"[^\W_]+(?:\.\d+)*")


def words(paragraph: str) -> list[str]:
    return _WORD.findall(paragraph.lower())


def grams(w: list[str]) -> set[str]:
    return {" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)}


def shingles(w: list[str]) -> set[tuple[str, ...]]:
    size = min(3, len(w))
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)} if w else set()


_SHAPES = {f: [shingles(words(t)) for t in ts] for f, ts in TEMPLATES.items()}

_TRIPLES = set().union(*(t for ts in _SHAPES.values() for t in ts))
_LONGEST = max(len(words(t)) for ts in TEMPLATES.values() for t in ts)


def mostly_template(w: list[str]) -> bool:
    own = shingles(w)
    return len(w) >= 3 and 2 * len(own & _TRIPLES) >= len(own)


def contained(w: list[str], family: str) -> float:
    """Largest share of a template of the family that the paragraph holds."""
    own = {n: {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} for n in (1, 2, 3)}
    return max(len(t & own[len(next(iter(t)))]) / len(t) for t in _SHAPES[family])


def made_paragraphs(ordinary: list[list[str]], rng: np.random.Generator) -> list[tuple[list[str], int]]:
    """Labelled word lists: whole templates and their larger parts, alone and between ordinary words; shorter parts are unknown."""
    out = []
    for label, family in enumerate(FAMILIES[1:], 1):
        for t in map(words, TEMPLATES[family]):
            for k in range(30):
                part = t
                if k % 3 == 1 and len(t) > 6:
                    cut = int(len(t) * 0.8)
                    at = int(rng.integers(0, len(t) - cut + 1))
                    part = t[at : at + cut]
                before, after = (ordinary[int(rng.integers(len(ordinary)))] if ordinary and k % 2 else [] for _ in range(2))
                out.append((before[: int(rng.integers(0, 40))] + part + after[: int(rng.integers(0, 40))], label))
            for k in range(6):  # a loose word or two of a notice is no notice
                at = int(rng.integers(0, len(t)))
                filler = ordinary[int(rng.integers(len(ordinary)))] if ordinary else []
                out.append((filler[:20] + t[at : at + 1] + filler[20:40], 0))
                if len(t) > 4:  # nor are its words in another order
                    out.append((filler[:20] + [t[i] for i in rng.permutation(len(t))] + filler[20:40], 0))
    return out


@dataclass
class Classifier:
    features: dict[str, int]
    weights: np.ndarray  # features + 1 (bias) x classes
    temperature: float

    def probabilities(self, found: list[int]) -> np.ndarray:
        z = (self.weights[found].sum(axis=0) + self.weights[-1]) / self.temperature
        e = np.exp(z - z.max())
        return e / e.sum()


def fit(ordinary: list[list[str]]) -> Classifier:
    """Train on made and ordinary paragraphs; deterministic in the order of ``ordinary``."""
    rng = np.random.default_rng(11)
    rows = made_paragraphs(ordinary, rng) + [(w, 0) for w in ordinary]
    of_templates = set().union(*(grams(words(t)) for ts in TEMPLATES.values() for t in ts))
    common: dict[str, int] = {}
    for w in ordinary:
        for g in set(w):
            common[g] = common.get(g, 0) + 1
    frequent = sorted(common, key=lambda g: (-common[g], g))[:MAX_COMMON]
    features = {g: i for i, g in enumerate(sorted(of_templates | set(frequent)))}
    x = np.zeros((len(rows), len(features) + 1), dtype=np.float32)
    for i, (w, _) in enumerate(rows):
        x[i, [features[g] for g in grams(w) if g in features]] = 1
    x[:, -1] = 1
    y = np.zeros((len(rows), len(FAMILIES)), dtype=np.float32)
    y[np.arange(len(rows)), [label for _, label in rows]] = 1
    held = rng.random(len(rows)) < 1 / 3
    weights = np.zeros((x.shape[1], len(FAMILIES)))
    m, s = np.zeros_like(weights), np.zeros_like(weights)
    xf, yf = x[~held], y[~held]
    for step in range(1, EPOCHS + 1):
        z = xf @ weights
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        g = xf.T @ (p - yf) / len(xf) + DECAY * weights
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        weights -= 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    z = x[held] @ weights

    def loss(t: float) -> float:
        a = z / t
        a = a - a.max(axis=1, keepdims=True)
        return float(-(y[held] * (a - np.log(np.exp(a).sum(axis=1, keepdims=True)))).sum())

    temperature = min((0.25 * 1.25**i for i in range(24)), key=loss) if held.any() else 1.0
    return Classifier(features, weights, temperature)


def train(docs: DataFrame, text_col: str = "text") -> Classifier:
    line = F.explode(F.split(F.col(text_col).cast("string"), "\n")).alias("p")
    few = docs.select(line).where((F.length(F.trim("p")) > 0) & (F.octet_length("p") <= SAMPLE_BYTES))
    sample = [words(r["p"]) for r in hash_sample(few, F.col("p"), SAMPLE).collect()]
    sample = [w for w in sample if w and max(contained(w, f) for f in TEMPLATES) < 0.5 and not mostly_template(w)]
    return fit(sample)


def judged(w: list[str], model: Classifier) -> tuple[str, float, float] | None:
    """(family, probability, contained) of a paragraph's words if it is a confirmed notice."""
    found = [model.features[g] for g in grams(w) if g in model.features] if w else []
    if not found:
        return None
    p = model.probabilities(found)
    best = int(p.argmax())
    if best and p[best] >= LEAST and (share := contained(w, FAMILIES[best])) >= CONTAINED:
        return FAMILIES[best], float(p[best]), share
    return None


def notices(lines: list[list[str]], model: Classifier) -> list[tuple[int, int, str, float, float]]:
    """(first line, last line, family, probability, contained) of the notices among the lines' words."""
    out = [(i, i, *j) for i, w in enumerate(lines) if (j := judged(w, model))]
    blocks, at = [], 0
    for i in range(len(lines) + 1):
        if i == len(lines) or not lines[i]:
            if i - at > 1:
                blocks.append((at, i))
            at = i + 1
    for a, b in blocks:
        flat = [x for w in lines[a:b] for x in w]
        held = set(zip(flat, flat[1:], flat[2:], strict=False)) & _TRIPLES
        if not any(len(t & held) >= CONTAINED * len(t) for ts in _SHAPES.values() for t in ts):
            continue
        # lines that hold a template's words: others neither begin nor end a run
        part = [bool(held.intersection(zip(flat[(k := max(0, n - 2)) :], flat[k + 1 :], flat[k + 2 : m + 2], strict=False))) for n, m in _spans(lines[a:b])]
        runs = []
        for i in range(a, b):
            inner = 0
            for j in range(i + 1, b) if part[i - a] else ():
                if inner >= _LONGEST:
                    break
                if part[j - a]:
                    runs.append((j - i, i, j))
                inner += len(lines[j])
        for _, i, j in sorted(runs):
            w = [x for y in lines[i : j + 1] for x in y]
            if not any(contained(w, f) >= CONTAINED for f in TEMPLATES) or not (now := judged(w, model)):
                continue
            if any(f == now[0] and i <= y and x <= j for x, y, f, _, _ in out):
                continue
            while j + 1 < b and (more := judged([x for y in lines[i : j + 2] for x in y], model)) and more[0] == now[0] and more[2] > now[2]:
                j, now = j + 1, more
            out.append((i, j, *now))
    return sorted(out)


def _spans(lines: list[list[str]]) -> list[tuple[int, int]]:
    """Positions of the lines' words among all of them."""
    out, at = [], 0
    for w in lines:
        out.append((at, at + len(w)))
        at += len(w)
    return out


SCHEMA = "id long, paragraph int, start long, end long, family string, probability double, contained double"


def detected(docs: DataFrame, model: Classifier, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, paragraph, start, end, family, probability, contained): the confirmed licence paragraphs (code points, end exclusive);
    ``paragraph`` is the number of the first line."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # a paragraph that holds enough of a template holds every word of one of its shingles: rare ones of these must occur
    telling = frozenset(w.encode() for w in _telling())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.string(), pa.float64(), pa.float64())
        for batch in batches:
            out: list[list] = [[] for _ in types]
            for key, raw in zip(batch.column(0).to_pylist(), text_bytes(batch.column(1)), strict=True):
                low = (raw or b"").lower()
                if not any(t in low for t in telling):
                    continue
                lines = raw.decode("utf-8", "replace").split("\n")
                starts = list(accumulate((len(line) + 1 for line in lines), initial=0))
                for first, last, family, p, share in notices(list(map(words, lines)), model):
                    for column, value in zip(out, (key, first, starts[first], starts[last] + len(lines[last]), family, p, share), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=["id", "paragraph", "start", "end", "family", "probability", "contained"])

    return rows.mapInArrow(run, SCHEMA)


def _telling() -> set[str]:
    """One word of at least five letters from every template: a paragraph that holds ``CONTAINED`` of a template's shingles
    has all words but those of the missing ones; so every word that lies in more than the missing share is there."""
    out = set()
    for shapes in _SHAPES.values():
        for t in shapes:
            missing = len(t) - int(np.ceil(CONTAINED * len(t)))
            # greedy: words until more shingles are covered than may be missing
            left, n = sorted(t), 0
            for w in sorted({w for s in t for w in s if len(w) >= 4}, key=lambda w: (-sum(w in s for s in t), -len(w), w)):
                covered = [s for s in left if w in s]
                if covered:
                    out.add(w)
                    n += len(covered)
                    left = [s for s in left if w not in s]
                if n > missing:
                    break
    return out
