"""The numbered operators on small hard cases: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""
import hashlib
import itertools
import random
import re
import string
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from riskframe.llm import decontaminate, licenses, minhash_join, mixing, secret_scan, surrogates, tokens, topk, toxicity, warc
from riskframe.llm.graph import components
from riskframe.llm.store import read_files, scratch
from riskframe.llm.words import sized

DOCS = "doc_id long, text string, score double, secrets string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, None, None) for i, t in texts], DOCS)


def words(rng, n, pool=400):
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def hard(rng):
    return [(100, None), (101, ""), (102, "  \n\t "), (103, "one"), (104, "one"), (None, "no id here at all in this one"), (105, " ".join(words(rng, 20000))), (106, "Ünï ç\x85ø\xa0d\x1fe")]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# ------------------------------------------------------------------ 1
ITEM = "A train with John Smith leaves at 9 and travels 300 km before Mary Jones meets it at 12 near the river"


def test_decontaminate(spark):
    rng = random.Random(1)
    noise = lambda n=40: " ".join(words(rng, n))
    changed = ITEM.replace("John Smith", "Peter Brown").replace("300", "450")
    rows = [(1, f"{noise()} {ITEM} {noise()}"), (2, f"{noise()} {changed} {noise()}"), (3, noise(200)), (4, ITEM.upper()), (5, " ".join(ITEM.split()[:6]) + noise()),
            (6, f"{noise()} {ITEM} {noise()}"), (6, f"{noise()} {ITEM} {noise()}"), (7, "9 300 12 9 300 12 9 300 12"), *hard(rng)]
    bench = spark.createDataFrame([(10, ITEM), (11, None), (12, ""), (13, "the"), (14, "alpha beta gamma delta")], "item_id long, text string")
    got = {(r["id"], r["item"]): r for r in decontaminate.contamination(docs(spark, rows), bench).collect()}
    assert set(got) == {(1, 10), (2, 10), (4, 10), (6, 10)}
    assert got[1, 10]["share"] == 1.0 and got[1, 10]["n_slots_changed"] == 0 and got[2, 10]["n_slots_changed"] == 3
    assert decontaminate.contamination(docs(spark, []), bench).count() == 0
    assert decontaminate.contamination(docs(spark, rows), bench.limit(0)).count() == 0


def test_inconsistent_slots_do_not_count(spark):
    item = "first John pays 5 coins today then John walks home and later John pays again some more"
    broken = item.replace("John", "Peter", 1).replace("John", "Marco", 1)
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    found = {r["id"] for r in decontaminate.contamination(docs(spark, [(1, item.replace("John", "Peter")), (2, broken)]), bench).collect()}
    assert found == {1}


def test_reparameterised_items_with_many_slots_and_opening_names(spark):
    dense = "Tom buys 3 pens and 4 books for 12 dollars in 2 shops"
    middle = "A farmer sells 6 red apples at noon. Tom eats one green pear near the old mill. Mary sings 2 songs there"
    full = "a letter from John Smith came to the house where Mary lives with 7 cats and one dog"
    table = "Tom pays 3 and 4 and 5 and 6 for hats"
    bench = spark.createDataFrame([(1, dense), (2, middle), (3, full), (4, table)], "item_id long, text string")
    rows = [(1, "see w " + dense.replace("3", "5").replace("4", "9").replace("12", "31").replace(" 2 ", " 6 ")), (2, middle.replace("Tom", "Anna Lee").replace("Mary", "Eva").replace("6", "8")),
            (3, full.replace("John Smith", "Anna").replace("Mary", "Eva Maria Brown")), (4, "By " + dense.replace("Tom", "Eva Brown").replace("12", "40") + " today"),
            (5, "find nothing of these 3 pens and 4 hats for 12 cats in 2 boats"), (6, dense.replace("Tom", "tom").replace("4", "8")),
            (7, table.replace("3", "13").replace("4", "14").replace("5", "15").replace("6", "16").replace("Tom", "Eva"))]
    got = {(r["id"], r["item"]): r for r in decontaminate.contamination(docs(spark, rows), bench).collect()}
    assert set(got) == {(1, 1), (2, 2), (3, 3), (4, 1), (6, 1), (7, 4)}
    assert all(r["n_found"] <= r["n_windows"] for r in got.values()) and got[1, 1]["share"] == 1.0 and got[3, 3]["share"] == 1.0


# ------------------------------------------------------------------ 2
def test_tokens_round_trip(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    rng = random.Random(2)
    pieces = list("ab é́\x85\xa0\x1c's ñ1½Ⅷ中.!?İK\n\t\x0b\x0c") + ["<|endoftext|>", "<|startoftext|>", "'ll", " ", "Word", "ÄRGER"]
    rows = [*hard(rng), *((i, "".join(rng.choice(pieces) for _ in range(rng.randrange(60)))) for i in range(60)), (3, "again"), (3, "again")]
    path = scratch(spark, "test-tokens")
    tokens.write_tokens(docs(spark, rows), path, shard_bytes=20000)
    t = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))
    whole = lambda x: [*t.encode(x or "", add_special_tokens=False).ids, 2]
    got = sorted(map(tuple, tokens.read_digests(spark, path).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted((r[0] for r in rows), key=lambda k: (k is not None, k))
    want = defaultdict(list)
    for k, x in rows:
        ids = whole(x)
        want[k].append((len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
    start, have = 0, defaultdict(list)
    for k, s, n, crc in got:
        assert s == start
        start += n
        have[k].append((n, crc))
    assert {k: sorted(v) for k, v in have.items()} == {k: sorted(v) for k, v in want.items()}
    files = [tokens.TokenFile(bytes(r["content"])) for r in read_files(spark, path).collect()]
    assert len(files) > 1
    assert [f.read_document(103).tolist() for f in files if f.read_document(103) is not None] == [whole("one")]
    assert all(f.read_document(99999) is None for f in files)
    broken = bytearray(read_files(spark, path).first()["content"])
    broken[20] ^= 1
    with pytest.raises(ValueError):
        tokens.TokenFile(bytes(broken))
    empty = scratch(spark, "test-tokens")
    tokens.write_tokens(docs(spark, []), empty)
    assert tokens.read_digests(spark, empty).count() == 0


def test_tokens_of_greek_capitals_equal_whole_text_encoding():
    import public_tokenizers
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER))
    texts = ["ΟΔΟΣ", "ΟΔΟΣ, η ΟΔΟΣ. Σ ΑΣ! οδός ΟΔΟΣΑ ΣΑΣ? ςΣ", "Word ΆΛΛΟΣ-ΕΝΑΣ İΣ"]
    encoder = tokens.Encoder(tokens.TOKENIZER)
    got = [np.frombuffer(x, dtype=encoder.dtype).tolist() for x in encoder.encode([x.encode() for x in texts])]
    assert got == [[*t.encode(x, add_special_tokens=False).ids, tokens.END] for x in texts]


def test_words_of_letters_with_trailing_marks_are_not_cut_by_the_pattern(monkeypatch):
    import public_tokenizers
    from tokenizers import Tokenizer

    text = "été été&&& Étéção,### abc&&& ABC$$$ abc' abc'. ---*** привет,%%% (abc <|endoftext|>, abc's"
    encoder = tokens.Encoder(tokens.TOKENIZER)

    def cut(word):
        assert not word.rstrip(string.punctuation).isalpha(), word
        return pattern.findall(word)

    pattern = tokens._CUT
    monkeypatch.setattr(tokens, "_CUT", type("Cut", (), {"findall": staticmethod(cut)}))
    got = np.frombuffer(next(encoder.encode([text.encode()])), dtype=encoder.dtype).tolist()
    whole = Tokenizer.from_file(public_tokenizers.path(tokens.TOKENIZER)).encode(text, add_special_tokens=False).ids
    assert got == [*whole, tokens.END]


def test_ids_outlive_a_generation_of_words(monkeypatch):
    texts = [b"one two, three", b"two four", None, b"two, one"] * 300
    want = list(tokens.Encoder(tokens.TOKENIZER).encode(texts))
    monkeypatch.setattr(tokens, "CACHE_WORDS", 2)
    encoder = tokens.Encoder(tokens.TOKENIZER)
    assert list(encoder.encode(texts)) == want and len(encoder.ids.old) <= 6 and not encoder.ids.old.old


# ------------------------------------------------------------------ 3
def test_warc_round_trip(spark):
    big, rng = "x" * 1000, random.Random(3)
    rows = [(1, "http://a/ b\n", big), (7, None, big), (3, "http://c", big), (4, "u", "small"), (5, "u", "small"), (6, "v", None), (None, "w", big), (8, "z", "é" * 800)]
    rows += [(100 + i, f"http://h/{i}", "<html>" + " ".join(words(rng, 300)) + "</html>") for i in range(300)]
    path = scratch(spark, "test-warc")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    got = {r["page_id"]: r for r in warc.read_archives(spark, path).collect()}
    assert len(got) == len(rows)
    for k, _, html in rows:
        raw = (html or "").encode()
        r = got[k]
        assert r["payload_bytes"] == len(raw) and r["payload_digest"] == hashlib.sha1(raw).hexdigest()
        if k in (1, 3, None):
            assert r["record_type"] == "revisit" and r["refers_to"] == 7 and r["payload"] is None
        else:
            assert r["record_type"] == "response" and r["refers_to"] is None and bytes(r["payload"]) == raw
    content = bytes(read_files(spark, path).first()["content"])
    assert int.from_bytes(content[:4], "little") == warc.DICTIONARY_FRAME and int.from_bytes(content[4:8], "little") > 1000
    empty = scratch(spark, "test-warc")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), empty)
    assert warc.read_archives(spark, empty, payload=False).count() == 0


# ------------------------------------------------------------------ 4
def test_factorization_machine_learns_a_pair():
    rng = np.random.default_rng(0)
    rows, y = [], []
    for _ in range(1500):
        a, b = rng.random(2) < 0.5
        terms = ({1} if a else set()) | ({2} if b else set()) | set(map(int, rng.integers(10, 60, 5)))
        rows.append(np.array(sorted(terms), dtype=np.int32))
        y.append(float(a and b))
    terms, bias, w, v = toxicity.fit(np.array(y), rows)
    m = toxicity.FactorizationMachine(bias, {int(t): i for i, t in enumerate(terms)}, w, v)
    s = lambda *t: m.score([m.terms[x] for x in t])
    assert s(1, 2) > 0.9 and s(1) < 0.3 and s(2) < 0.3 and s() < 0.3
    i, j = m.terms[1], m.terms[2]
    assert float(v[i] @ v[j]) > 0.5


def test_toxicity_scores(spark):
    rng = random.Random(4)
    texts = [(i, " ".join(words(rng, 60) + (["vile", "vilestem"] if i % 4 == 0 else []))) for i in range(1000, 1400)] + hard(rng)
    d = docs(spark, texts)
    labels = spark.createDataFrame([(i, 1, int(i % 4 == 0)) for i in range(1000, 1300)] + [(1305, 1, None), (None, 0, 1), (1307, 0, 9)], "doc_id long, quality int, toxic int")
    out = by_id(toxicity.scored(d, toxicity.train(d, labels)))
    assert all((out[i]["score"] >= 0.7) == (i % 4 == 0) for i in range(1000, 1400))
    assert all(0 <= out[k]["score"] < 0.7 for k in (100, 101, 102, None))
    flat = toxicity.scored(d, toxicity.train(d, labels.limit(0))).select("score").distinct().collect()
    assert [r[0] for r in flat] == [0.5]
    assert toxicity.scored(d.limit(0), toxicity.train(d, labels)).count() == 0


# ------------------------------------------------------------------ 5
def brute_components(rows):
    sets, parent = {}, {}
    for k, t in rows:
        w = (t or "").encode().lower().split()
        sets[k] = {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        parent[k] = k

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    near = defaultdict(set)
    for k, s in sets.items():
        for x in s:
            near[x].add(k)
    pairs = Counter(p for v in near.values() if len(v) > 1 for p in itertools.combinations(sorted(v), 2))
    for (a, b), n in pairs.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = sorted((root(a), root(b)))
            parent[b] = a
    return {k: (len(sets[k]), root(k)) for k in sets}


def test_near_duplicates_against_all_pairs(spark):
    rng = random.Random(5)
    rows, k = [(i, t) for i, t in hard(rng) if i is not None], 1000
    shared = words(rng, 60)
    for family in range(30):
        base = words(rng, rng.choice([4, 8, 30, 80, 300]))
        for _ in range(rng.choice([1, 2, 5, 40])):
            w = list(base)
            for _ in range(rng.randrange(0, 1 + len(w) // 18)):
                w[rng.randrange(len(w))] = f"x{rng.randrange(10**6)}"
            rows.append((k, " ".join(w).upper() if k % 7 == 0 else "\t".join(w)))
            k += 1
    rows += [(k + i, " ".join(shared + words(rng, 40))) for i in range(60)]
    got = {r["id"]: (r["n_shingles"], r["component"]) for r in minhash_join.classes(docs(spark, rows)).collect()}
    assert got == brute_components(rows)


def test_near_duplicates_edges(spark):
    rows = [(5, "a b c d e f"), (5, "a b c d e f"), (None, "a b c d e f"), (2, "A B C D E F"), (9, None)]
    got = sorted((tuple(r) for r in minhash_join.classes(docs(spark, rows)).collect()), key=str)
    assert got == sorted([(5, 2, 2), (5, 2, 2), (None, 2, None), (2, 2, 2), (9, 0, 9)], key=str)
    assert minhash_join.classes(docs(spark, [])).count() == 0


def test_pigeonhole_finds_every_pair_within_the_distance():
    rng = np.random.default_rng(1)
    import pyarrow as pa

    a = rng.integers(0, 65536, (200, minhash_join.HASHES)).astype("<u2")
    b = a.copy()
    for row in b:  # exactly the largest distance, anywhere
        at = rng.choice(minhash_join.HASHES, minhash_join.MAX_DISTANCE, replace=False)
        row[at] ^= 1
    sig = np.zeros(400, dtype=minhash_join.SIG)
    sig["symbols"] = np.concatenate([a, b])
    batch = pa.RecordBatch.from_arrays([pa.array(np.arange(400)), pa.array([s.tobytes() for s in sig], pa.binary())], names=["node", "sig"])
    keys = defaultdict(set)
    for out in minhash_join._keyed(iter([batch])):
        for node, key in zip(out.column(0).to_pylist(), out.column(1).to_pylist(), strict=True):
            keys[node].add(key)
    assert all(keys[i] & keys[i + 200] for i in range(200))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (100, 102)], "a long, b long")
    got = dict(map(tuple, components(edges).collect()))
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


# ------------------------------------------------------------------ 6
def test_surrogates_keep_form_distinctness_and_coreference(spark):
    p = surrogates.Permutation(b"k")
    small = [p.after(x, 10, "t") for x in range(10)]
    assert sorted(small) == list(range(10)) and all(a != b for a, b in enumerate(small))
    assert len({surrogates.surrogate(p, "email", f"{a}{b}@x.org") for a in "abcdefghij" for b in "0123456789"}) == 100
    one, two = (surrogates.rewrite(t, p)[0] for t in ("call +1 (988) 555-2485 now", "call 988-555-2485 now"))
    assert re.sub(r"\D", "", one)[1:] == re.sub(r"\D", "", two) and re.fullmatch(r"call \+1 \(\d{3}\) \d{3}-\d{4} now", one)
    card = re.sub(r"\D", "", surrogates.surrogate(p, "card", "4111 1111 1111 1111"))
    assert card[0] == "4" and surrogates.luhn(card[:-1]) == int(card[-1])
    assert surrogates.rewrite("Frau Anna und Frau Anna", p)[1][0][2].split()[1] in surrogates.NAMES["latin", "f"]
    rng = random.Random(6)
    rows = [(1, "mail Bob.42@Mail8.example.com from 42.144.35.254, Mr. Иван"), (2, "bob.42@mail8.example.com 4041894974608795"), (3, "nothing here"), *hard(rng)]
    d = docs(spark, rows).withColumn("entities", F.lit("clash"))
    out = surrogates.replaced(d, "key")
    got = by_id(out)
    assert got[3]["text"] == "nothing here" and got[101]["text"] == "" and got[105]["text"] == dict(rows)[105]
    assert "42.144.35.254" not in got[1]["text"] and "4041894974608795" not in got[2]["text"]
    assert got[1]["entities"][0]["surrogate"] == got[2]["entities"][0]["surrogate"]
    assert surrogates.collisions(out).count() == 0
    bad = spark.createDataFrame([([("email", "a", "z"), ("email", "b", "z")],)], "entities array<struct<kind:string,entity:string,surrogate:string>>")
    assert surrogates.collisions(bad).count() == 1


def test_surrogates_of_names_without_title_and_unicode_addresses():
    p = surrogates.Permutation(b"k")
    new = lambda t: surrogates.rewrite(t, p)[0]
    out = new("Smith came. Mr. John Smith met Anna Schmidt; Smith left, Schmidt's dog stayed. Anna slept.")
    assert not re.search("Smith|Schmidt|John|Anna", out) and out.endswith(" slept.") and "'s dog stayed" in out
    (one,), (two,) = (re.findall(r"Mr\. \w+ (\w+) met", out), re.findall(r"; (\w+) left", out))
    assert one == two == out.split()[0]
    assert "Peter" not in (x := new("with John Peter F. Miller today")) and "Miller" not in x and x.endswith(" today")
    assert "Иван" not in (x := new("г-н Иван Петров пришёл, Петров ушёл")) and "Петров" not in x and x.startswith("г-н ") and x.endswith(" ушёл")
    assert "Παππας" not in (x := new("Anna Παππας wrote, Παππας left")) and x.split()[1] == x.split()[3]
    for local in ("müller.19", "иван", "MÜLLER", "ab" * 50, "x" * 300 + "ü", "ΟΔΟΣ"):
        (kind, entity, made), = surrogates.rewrite(f"to {local}@x.de now", p)[1]
        assert kind == "email" and len(entity) == len(local) + 5 and made != entity and made[: len(local)] != entity[: len(local)]
    seen = [surrogates.surrogate(p, "email", f"ü{a}{b}@x.org") for a in "àáâãäåæç" for b in "аб"]
    assert len(set(seen)) == len(seen)


# ------------------------------------------------------------------ 7
def test_mix_meets_targets_and_reruns_agree(spark):
    rng = random.Random(7)
    rows = [(i, rng.choice(["a", "a", "a", "b", "c", None]), " ".join(words(rng, rng.randrange(0, 80)))) for i in range(6000)] + [(None, "b", "x y"), (3, "a", "p q"), (3, "a", "p q")]
    d = sized(spark.createDataFrame(rows, "doc_id long, source string, text string"), "text", "size", keep_text=False).withColumn("copies", F.lit("clash"))
    first, second = (sorted((tuple(r) for r in mixing.mixed(x).collect()), key=str) for x in (d, d.repartition(13)))
    assert first == second and len(first) == len(rows)
    sizes, taken, target, most = Counter(), Counter(), {}, 0
    for _, source, size, total, t, copies in first:
        sizes[source] += size
        taken[source] += copies * size
        target[source] = t
        assert 0 <= copies <= 2
        most = max(most, size)
    order = sorted((s for s in sizes if s is not None)) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    want, free, left = {}, set(order), 1.5 * sum(sizes.values())
    while True:
        level = left / sum(weight[s] for s in free)
        over = {s for s in free if weight[s] * level >= 2 * sizes[s]}
        if not over:
            break
        for s in over:
            want[s] = 2.0 * sizes[s]
            left -= want[s]
        free -= over
    want |= {s: weight[s] * level for s in free}
    assert all(abs(want[s] - target[s]) < 1e-6 * want[s] for s in order)
    assert all(abs(taken[s] - target[s]) <= most for s in order)
    assert mixing.mixed(d.limit(0)).count() == 0


# ------------------------------------------------------------------ 8
def test_top_k_against_brute_force(spark):
    rng = np.random.default_rng(8)
    v = rng.normal(0, 0.15, (900, 12)).astype(np.float32)
    v[300:420] = v[300]  # a hot vector
    rows = [(int(i), [float(x) for x in v[i]]) for i in range(900)] + [(2000, None), (2020, [1.0] * 11 + [None]), (2040, [float("nan")] * 12), (2060, [0.5, 0.25]), (None, [0.0] * 12), (40, [0.1] * 12)]
    got = defaultdict(list)
    for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0, k=7).collect():
        got[r["query_id"]].append((r["rank"], r["id"], r["score"]))
    full = [(k, np.floor(64 * np.array(x, dtype=float)).astype(int)) for k, x in rows if k is not None and x and len(x) == 12 and all(c is not None and np.isfinite(c) for c in x)]
    for q, x in full:
        if q % 20 == 0 and q != 40:
            best = sorted(((k, int(y @ x)) for k, y in full if k != q), key=lambda r: (-r[1], r[0]))[:7]
            assert sorted(got[q]) == [(n + 1, *b) for n, b in enumerate(best)], q
    assert 2060 not in got and topk.top_k(spark.createDataFrame([], "vec_id long, embedding array<double>"), F.col("id") % 20 == 0).count() == 0


def test_top_k_of_repeated_ids(spark):
    rng = np.random.default_rng(88)
    v = rng.normal(0, 0.15, (300, 8))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    rows = [(int(i), [float(x) for x in v[i]]) for i in range(300)]
    rows += [(20, rows[20][1])] * 25  # a query's own copies score best
    rows += [(40, rows[7][1]), (40, rows[60][1]), (41, rows[60][1])]  # one query on three vectors, one shared with query 60
    rows += [(7, [0.3 * x for x in rows[i][1]]) for i in range(100, 130)] + [(9, rows[80][1])] * 3
    got = defaultdict(list)
    for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), F.col("id") % 20 == 0, k=6).collect():
        got[r["query_id"]].append((r["rank"], r["id"], r["score"]))
    full = [(k, np.floor(64 * np.array(x)).astype(int)) for k, x in rows]
    for q in range(0, 300, 20):
        best = sorted(((k, int(y @ x)) for i, x in full if i == q for k, y in full if k != q), key=lambda r: (-r[1], r[0]))[:6]
        assert sorted(got[q]) == [(n + 1, *b) for n, b in enumerate(best)], q


# ------------------------------------------------------------------ 9
def test_secrets(spark):
    rng = random.Random(9)
    key = lambda n: "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))
    stray = "q7Zk9XwB2vT4mRp8LsYd3"
    prose = "the quick brown fox jumps over a lazy dog while seven tall giraffes watch from behind an old wooden fence".split()
    rows = [(i, " ".join(rng.choices(prose, k=60)) + f" password={key(12)} and the ordinary_identifier_of_things") for i in range(60)]
    rows += [(200, "ñ API_KEY: 'abc' token=secret:abcdefgh12 AKIA" + "A1" * 8 + " AKIAX " + "0af" * 12 + " abcdef"), (201, f"see {stray} here"), *hard(rng)[:6], (105, " ".join(rng.choices(prose, k=20000))), hard(rng)[7]]
    out = secret_scan.scanned(docs(spark, rows), secret_scan.train(docs(spark, rows)))
    got = {r["doc_id"]: [(s["kind"], s["start"], s["end"]) for s in r["secrets"]] for r in out.collect()}
    for k, t in rows:
        t = t or ""
        base = [(m.start(), "assign", m.end()) for m in re.finditer(secret_scan.ASSIGN, t, re.I | re.A) if len(m[2]) >= 8]
        base += [(m.start(), "access", m.end()) for m in re.finditer(secret_scan.ACCESS, t) if len(m[0]) >= 16]
        base += [(m.start(), "hex", m.end()) for m in re.finditer(secret_scan.HEX, t) if len(m[0]) >= 32]
        assert [s for s in got[k] if s[0] != "markov"] == [(x[1], x[0], x[2]) for x in sorted(base, key=lambda x: (x[0], secret_scan.KINDS.index(x[1])))]
    assert got[201] == [("markov", 4, 4 + len(stray))]
    assert not any(s[0] == "markov" for k, v in got.items() if k != 201 for s in v)
    assert secret_scan.scanned(docs(spark, []), secret_scan.train(docs(spark, []))).count() == 0


# ------------------------------------------------------------------ 10
def test_licenses(spark):
    rng = random.Random(10)
    notes = {1: "Released under the MIT License.", 2: "Licensed under the Apache License, Version 2.0.", 3: "All rights reserved.", 4: "Licensed under CC BY-NC 4.0."}
    rows = [(k, " ".join(words(rng, 50)) + "\n" + t + "\nend") for k, t in notes.items()] + [(20, "the public license of the house was under general version"), *hard(rng)]
    rows += [(300 + i, "\n".join(" ".join(words(rng, 30)) for _ in range(5))) for i in range(40)]
    model = licenses.train(docs(spark, rows))
    got = {r["id"]: r for r in licenses.detected(docs(spark, rows), model).collect()}
    assert {k: r["family"] for k, r in got.items()} == {1: "mit", 2: "apache-2.0", 3: "all-rights-reserved", 4: "cc-by-nc"}
    assert dict(rows)[2][got[2]["start"] : got[2]["end"]] == notes[2] and got[2]["paragraph"] == 1
    assert licenses.detected(docs(spark, []), licenses.train(docs(spark, []))).count() == 0


MIT = """MIT License

Copyright (c) 2020 A. Writer

Permission is hereby granted, free of charge, to any person obtaining a copy
of this software and associated documentation files (the "Software"), to deal
in the Software without restriction, including without limitation the rights
"""
BSD = """ * Redistribution and use in source and binary forms, with or without
 * modification, are permitted provided that the following conditions
 * are met:
 *
 * 1. Redistributions of source code must retain the above notice"""


def test_wrapped_licenses(spark):
    rng = random.Random(11)
    prose = lambda n: "\n".join(" ".join(words(rng, 12)) for _ in range(n))
    rows = [(1, MIT), (2, prose(3) + "\n" + BSD), (3, "Released under the MIT License.\n" + prose(2)), (4, prose(3) + "\nThis Source Code Form is subject\r\nto the terms of the Mozilla\r\nPublic License, v. 2.0. If a copy"),
            (5, "Permission is hereby granted, free of charge, to any person obtaining a copy\n\nof this software and associated documentation files")]
    rows += [(300 + i, prose(5)) for i in range(40)]
    got = [tuple(r) for r in licenses.detected(docs(spark, rows), licenses.train(docs(spark, rows))).collect()]
    assert sorted((r[0], r[4]) for r in got) == [(1, "mit"), (2, "bsd"), (3, "mit"), (4, "mpl-2.0")]
    span = {r[0]: dict(rows)[r[0]][r[2] : r[3]] for r in got}
    assert span[1] == "\n".join(MIT.split("\n")[4:6]) and span[3] == "Released under the MIT License."
    assert span[2].startswith(" * Redistribution and use") and span[2].endswith("are met:") and "terms of the Mozilla" in span[4]
