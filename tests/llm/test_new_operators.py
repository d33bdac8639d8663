"""Passages, filter audit and hard negatives against plain Python, with odd rows among the ordinary ones."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docloom.llm import decontaminate, filter_audit, fm_index, hard_negatives, substring_dedup

SCHEMA = "doc_id long, text string, lang string"
CLASHING = {c: "x" for c in ("digest", "key", "mask", "part", "places", "segments", "words", "_key", "filter", "id", "v", "rank")}
WORD = re.compile(r"[^\x20\t-\r]+")


# Passages


def kept_words(rows, window):
    """(doc_id, text, words, kept) of every row, window by window."""
    holders = {}
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        for i in range(len(words) - window + 1) if doc_id is not None else ():
            key = tuple(words[i : i + window])
            holders[key] = min(holders.get(key, doc_id), doc_id)
    out = []
    for doc_id, text in rows:
        words = WORD.findall(text or "")
        gone = set()
        for i in range(len(words) - window + 1) if doc_id is not None else ():
            if holders[tuple(words[i : i + window])] < doc_id:
                gone.update(range(i, i + window))
        out.append((doc_id, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return Counter(out)


def passages():
    rng = random.Random(5)

    def prose(n, vocabulary=3000):
        return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]

    shared, long = prose(40), prose(400)
    rows = []
    for i in range(80):
        words = prose(rng.randrange(0, 120))
        if i % 3 == 0:
            at, cut = rng.randrange(len(words) + 1), rng.randrange(5, 41)
            words[at:at] = shared[:cut]
        if i % 8 == 0:
            words = list(long)
            for _ in range(i // 8):
                words[rng.randrange(400)] = f"x{rng.randrange(10**6)}"
        rows.append((i, rng.choice([" ", "\n", " \t "]).join(words)))
    few = "a b a b a b a a b b a"
    rows += [
        (200, None), (201, ""), (202, " \n\t "), (203, " ".join(shared[:12])), (204, " ".join(shared[:13])),
        (205, " ".join(shared)), (205, " ".join(shared)), (205, " ".join(prose(10) + shared[3:30])), (None, " ".join(shared)),
        (206, "Z " * 3000), (207, "Z " * 500), (208, "z " * 40), (209, " ".join([few] * 9)), (210, " ".join([few] * 5)),
        (211, " ".join(shared)), (212, "é\U0001f600 " * 20), (213, "é\U0001f600 " * 30), (-5, " ".join(long[50:90])),
        (214, "y" * 300000 + " " + " ".join(long[:20])), (215, " ".join(prose(30000, 50))), (216, None), (None, None),
    ]
    return rows


@pytest.fixture(scope="module")
def texts(spark):
    rows = passages()
    frame = spark.createDataFrame([(i, t, "en") for i, t in rows], SCHEMA).withColumns({c: F.lit(v) for c, v in CLASHING.items()})
    return rows, frame.repartition(3).cache()


def test_passages_equal_plain_python(texts):
    rows, frame = texts
    for window in (13, 3):
        got = Counter(tuple(r) for r in substring_dedup.drop_repeated_passages(frame, window).collect())
        assert got == kept_words(rows, window)


def test_passages_of_split_keys_and_small_shards(texts, monkeypatch):
    rows, frame = texts
    monkeypatch.setattr(substring_dedup, "HOT_DOCS", 6)
    monkeypatch.setattr(substring_dedup, "SHARD_WORDS", 500)
    got = Counter(tuple(r) for r in substring_dedup.drop_repeated_passages(frame).collect())
    assert got == kept_words(rows, 13)


def test_no_passages(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert substring_dedup.drop_repeated_passages(empty).collect() == []
    one = spark.createDataFrame([(1, "a " * 50, "en")], SCHEMA)
    assert [tuple(r)[:3] for r in substring_dedup.drop_repeated_passages(one).collect()] == [(1, 50, 0)]


@settings(deadline=None, max_examples=60)
@given(st.lists(st.lists(st.integers(1, 4), min_size=1, max_size=12), min_size=1, max_size=6), st.integers(1, 5))
def test_index_finds_every_match(sequences, most):
    text = np.array([c for s in sequences for c in [*s, 0]])
    owner = np.array([i for i, s in enumerate(sequences) for _ in range(len(s) + 1)])
    index = fm_index.FMIndex(text, owner, 5, len(sequences), most)
    ends = np.array([e for e in range(len(text)) if text[e] and all(text[e - k] for k in range(min(most, e + 1))) and e + 1 >= most])
    if not len(ends):
        return
    length, low, high = index.matching_statistics(text, ends, most)
    for e, n, lo, hi in zip(ends, length, low, high):
        def found(k):
            return [p for p in range(len(text)) if list(text[p : p + k]) == list(text[e - k + 1 : e + 1])]

        assert n == max([k for k in range(1, most + 1) if len(found(k)) > 1], default=0)
        if n:
            assert hi - lo == len(found(n))
            assert index.documents.smallest(np.array([lo]), np.array([hi]))[0] == min(owner[p] for p in found(n))


# Filter audit


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    least = {}
    for doc_id, text, _ in rows:
        if doc_id is not None:
            least[text or ""] = min(least.get(text or "", doc_id), doc_id)
    documents = []
    for doc_id, text, part in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {
            "A": len(words) < 200, "B": 100 * len(set(words)) < 50 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 3 * len(text), "D": bool(re.search(r"[#$%&*|]", text)),
            "E": doc_id is not None and doc_id > least[text],
        }
        documents.append((part or "", {f for f in fails if fails[f]}, doc_id in good, doc_id in toxic))
    out, shapley = [], Counter()
    for part in {d[0] for d in documents}:
        own = [d for d in documents if d[0] == part]
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [d for d in left if f in d[1]]
                left = [d for d in left if f not in d[1]]
                shapley[part, f] += len(gone)
                failing = sum(f in d[1] for d in own)
                out.append(
                    (part, "".join(order), step, f, len(left), len(gone), failing - len(gone), sum(d[1] == {f} for d in own),
                     sum(d[2] for d in gone), sum(d[3] for d in gone))
                )
    return {(p, o, s, *rest, shapley[p, f]) for p, o, s, f, *rest in out}


def test_audit_equals_plain_python(spark):
    rng = random.Random(8)
    rows = []
    for i in range(120):
        words = [rng.choice(["alpha", "Beta", "gamma", "#x", "50%"][: rng.randrange(1, 6)]) + str(rng.randrange(300)) for _ in range(rng.choice([10, 199, 200, 260]))]
        rows.append((i, " ".join(words), rng.choice(["en", "de", None, ""])))
    rows += [(i + 300, rows[i % 7][1], rng.choice(["en", "fr"])) for i in range(20)]
    rows += [(7, rows[8][1], "de"), (7, rows[7][1], "de"), (None, rows[9][1], "en"), (None, rows[9][1], "en"), (501, None, None), (500, "", "en")]
    rows += [(600, "a " * 90000, "en"), (601, None, "en")]
    labels = [(i, rng.choice([0, 1, None]), rng.choice([0, 1, None])) for i in range(0, 140, 2)] + [(7, 1, 1), (7, 1, 1), (None, 1, 1)]
    docs = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(v) for c, v in CLASHING.items()})
    named = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    columns = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = [tuple(r) for r in filter_audit.audit(docs, named).select(*columns).collect()]
    assert len(got) == len(set(got)) and set(got) == brute_audit(rows, labels)


def test_audit_of_nothing(spark):
    docs, labels = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(docs, labels).collect() == []
    one = filter_audit.audit(spark.createDataFrame([(1, "one", "en")], SCHEMA), labels).collect()
    assert len(one) == 600 and {r.removed for r in one} == {0, 1}


# Hard negatives


@settings(deadline=None, max_examples=40)
@given(st.integers(1, 40), st.integers(1, 40), st.integers(1, 40), st.integers(0, 10**6), st.sampled_from([2, 4, 64]))
def test_strassen_is_the_product(m, k, n, seed, leaf):
    rng = np.random.default_rng(seed)
    a, b = rng.integers(-(2**40), 2**40, (m, k)), rng.integers(-(2**18), 2**18, (k, n))
    assert (hard_negatives.strassen(a, b, leaf) == a @ b).all()


def brute_negatives(rows, every):
    used = [
        (i, c, [math.floor(256 * x) for x in v]) for i, v, c in rows
        if i is not None and c is not None and v and all(x is not None and math.isfinite(x) for x in v)
    ]
    anchors = {}
    for i, c, v in sorted((i, c, v) for i, c, v in used if i % every == 0):
        anchors.setdefault(i, (c, v))
    out = []
    for a, (label, w) in anchors.items():
        scored = [(-sum(x * y for x, y in zip(v, w)), i, c) for i, c, v in used if i != a and len(v) == len(w)]
        for p, i, _ in sorted(s for s in scored if s[2] == label)[:5]:
            inside = sorted((n, j) for n, j, c in scored if c != label and 80 * -p <= 100 * -n <= 100 * -p)[:5]
            out += [(a, i, r, j, -p, -n) for r, (n, j) in enumerate(inside, 1)]
    return Counter(out)


def test_negatives_equal_plain_python(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "TILE_ROWS", 16)
    monkeypatch.setattr(hard_negatives, "GROUP_ROWS", (40, 40))
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", 8)
    rng = random.Random(4)
    rows = [(i, [float(rng.gauss(0.2, 1)) for _ in range(6)], rng.randrange(4)) for i in range(260)]
    same = [0.5] * 6
    rows += [(i, same, i % 2) for i in range(300, 330)]
    rows += [(330, None, 1), (340, same, None), (350, [1.0, None, 1.0, 1.0, 1.0, 1.0], 1), (360, [float("nan")] * 6, 1), (370, [float("inf")] * 6, 1)]
    rows += [(380, [], 1), (390, [1.0, 2.0], 1), (391, [1.0, 2.5], 1), (392, [1.0, 1.9], 2), (400, same, 9), (-10, same, 1), (None, same, 1)]
    rows += [(410, same, 1), (410, [0.4] * 6, 1), (411, same, 1), (411, same, 1), (420, [0.0] * 6, 1), (430, [-1.0] * 6, 2)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumns({c: F.lit(v) for c, v in CLASHING.items()})
    got = hard_negatives.mine(frame.repartition(3), F.col("id") % 10 == 0)
    assert Counter(tuple(r) for r in got.collect()) == brute_negatives(rows, 10)


def test_heaps_merge():
    rng = np.random.default_rng(1)
    scores, ids = rng.integers(0, 5, (7, 90)), rng.permutation(90)
    whole, left, right = (hard_negatives.Heaps(7, 4) for _ in range(3))
    whole.offer(scores, ids, np.ones((7, 90), bool))
    left.offer(scores[:, :30], ids[:30], np.ones((7, 30), bool))
    right.offer(scores[:, 30:], ids[30:], np.ones((7, 60), bool))
    left.merge(right.row, right.score, right.id)
    assert all((x == y).all() for x, y in ((whole.row, left.row), (whole.score, left.score), (whole.id, left.id)))
    want = [sorted(zip(-scores[r], ids))[:4] for r in range(7)]
    assert [(-s, i) for s, i in zip(whole.score, whole.id)] == [x for r in want for x in r]


def test_nothing_to_mine(spark):
    empty = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert hard_negatives.mine(empty).collect() == []


def test_digest_of_passages_is_of_the_kept_text(spark, tmp_path):
    rows = [(1, " ".join(f"w{i}" for i in range(20)), "en", "s", 1), (2, "x " + " ".join(f"w{i}" for i in range(13)) + " y", "en", "s", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.op11_substring_dedup(spark, str(tmp_path)).collect()}
    assert got[2] == (15, 13, hashlib.sha256(b"x y").hexdigest()) and got[1][:2] == (20, 0)


# Contained items


@pytest.mark.parametrize("percent", [80, 50])
def test_items_in_overlapping_pieces_are_all_found(spark, percent):
    rng = random.Random(percent)

    def prose(n):
        return [f"w{rng.randrange(5000)}" for _ in range(n)]

    items = [(i, prose(14)) for i in range(300)]
    # In two pieces that overlap by less than a shingle less one word, so that all shingles are there, or in scattered shingles.
    docs = [(i, prose(20) + w[:9] + prose(9) + w[5:] + prose(7)) for i, w in items]
    docs += [(1000 + i, sum((prose(3) + w[k : k + 5] for k in rng.sample(range(10), rng.randrange(3, 11))), [])) for i, w in items]

    def shingles(words):
        return {tuple(words[k : k + 5]) for k in range(len(words) - 4)}

    want = {
        (i, d) for i, w in items for d, text in docs if d % 1000 == i and 100 * len(shingles(w) & shingles(text)) >= percent * len(shingles(w))
    }
    frames = [spark.createDataFrame([(k, " ".join(w)) for k, w in rows], f"{name} long, text string") for rows, name in ((items, "item_id"), (docs, "doc_id"))]
    found = decontaminate.contained_items(frames[1].repartition(5), frames[0], percent)
    assert {(r.item_id, r.doc_id) for r in found.collect()} == want and {(i, i) for i in range(300)} <= want
