"""Spelling variants, the set join and the integer centroids against plain loops."""

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from test_operators import docs, given, no_docs  # noqa: F401

from tillstream.llm import centroids, set_join, spelling

# ---- 11: spelling variants -----------------------------------------------------------------


def lowered(text):
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def brute_words(rows):
    found = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = lowered(run)
            h = zlib.crc32(f"{i}:{run}".encode())
            if i is not None and h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            found[run] += 1
    return {w: n for w, n in found.items() if len(w) >= 7 and n >= 2}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def brute_variants(counts, times=10):
    out, forms = [], {}
    near = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        forms[w] = best if best is not None and counts[best] >= times * counts[w] else None
    for w, n in counts.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        out.append((w, forms[w], root, n, len(near[w]), counts[forms[w]] if forms[w] else None))
    return sorted(out, key=repr)


def edited(chance, word):
    k, letter = chance.randrange(len(word)), chance.choice("abexyé")
    return chance.choice([word[:k] + word[k + 1 :], word[:k] + letter + word[k:], word[:k] + letter + word[k + 1 :]])


def made_words(seed, n=60):
    chance = random.Random(seed)
    counts = {}
    for _ in range(n):
        word = "".join(chance.choices("abexyé", k=chance.choice([7, 8, 9, 12])))
        counts[word] = chance.choice([2, 20, 300, 4000])
        for _copy in range(3):
            word = edited(chance, word)
            if len(word) >= 7:
                counts.setdefault(word, chance.choice([2, 2, 20, 250]))
    counts["a" * 5000], counts["a" * 5001] = 2, 40  # very long words
    counts["x" * 70 + "y"], counts["x" * 71] = 2, 2
    return counts


@pytest.mark.parametrize("filter_bytes", [spelling.FILTER_BYTES, 1024])
def test_variants(spark, filter_bytes):
    counts = made_words(1)
    vocabulary = spark.createDataFrame([*counts.items(), (None, 3)], "word string, n long")
    found = spelling.spelling_variants(vocabulary, filter_bytes=filter_bytes)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_variants(counts)


def test_chain_of_forms(spark):
    counts = {"aaaaaaaa": 1000000, "aaaaaaab": 100000, "aaaaaabb": 10000, "aaaaabbb": 1000, "aaaabbbb": 100, "aaabbbbb": 10}
    found = spelling.spelling_variants(spark.createDataFrame(list(counts.items()), "word string, n long"))
    assert {r["root"] for r in found.collect()} == {"aaaaaaaa"}
    assert sorted(map(tuple, found.collect()), key=repr) == brute_variants(counts)


def test_false_positives_are_removed(spark):
    """Filters that say yes to everything give the same result: the join decides."""
    counts = {"letters": 2, "lettera": 30, "another": 5}
    vocabulary = spark.createDataFrame(list(counts.items()), "word string, n long")
    candidates = spark.createDataFrame([("letters", 2, "lettera"), ("another", 5, "anothex")], "word string, n long, near string")
    known = vocabulary.select(vocabulary["word"].alias("near"), vocabulary["n"].alias("near_n"))
    assert [r["near"] for r in candidates.join(known, "near").collect()] == ["lettera"]
    assert {tuple(r) for r in spelling.near_words(vocabulary).collect()} == {("letters", "lettera", 30), ("lettera", "letters", 2)}


def test_words_of_documents(spark, docs, no_docs):
    chance = random.Random(3)
    words = [w for w in made_words(2) if len(w) < 30]
    rows = given(docs) + [(i, " ".join(chance.choices(words, k=200)).title() + " × ÀÉÎÕÜÿ-") for i in range(20)]
    rows += [(None, "without without number"), (7, "Ångström Ångström ångström"), (7, None)]
    df = spark.createDataFrame([(*r, 1, "w") for r in rows], "doc_id long, text string, n long, word string")
    found = spelling.document_variants(df)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_variants(brute_words(rows))
    assert spelling.document_variants(no_docs).collect() == []


# ---- 12: set join --------------------------------------------------------------------------


def brute_set(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered(text))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[k : k + 5]) for k in range(len(words) - 4))


def brute_components(rows):
    sets = [brute_set(t) for _i, t in rows]
    root = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = root[a], root[b]
                root = [y if r == x else r for r in root]
    out = []
    for k, (i, _t) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if root[j] == root[k]]
        out.append((i, len(sets[k]), min((x for x in ids if x is not None), default=None), len(ids)))
    return sorted(out, key=repr)


def made_texts(seed, groups=12):
    chance = random.Random(seed)
    passage = [f"p{k}" for k in range(40)]
    rows = []
    for g in range(groups):
        base = [f"g{g}w{k}" for k in range(chance.choice([3, 6, 30, 90, 300]))]
        if chance.random() < 0.5:
            base += passage
        for _copy in range(chance.choice([1, 2, 5, 12])):
            words = list(base)
            for _edit in range(chance.randrange(0, 1 + len(words) // 20)):
                words[chance.randrange(len(words))] = f"e{chance.random()}"
            rows.append((len(rows) + 1, chance.choice([" ", "\n", "  "]).join(words)))
            if chance.random() < 0.2:
                base = words  # chains of copies
    return rows


@pytest.mark.parametrize("seed, block, hot", [(1, 2048, 256), (2, 3, 4), (3, 2, 2)])
def test_components(spark, docs, monkeypatch, seed, block, hot):
    monkeypatch.setattr(set_join, "BLOCK", block)
    monkeypatch.setattr(set_join, "PARTNERS", block)
    monkeypatch.setattr(set_join, "HOT", hot)
    rows = given(docs) + [(i + 100, t) for i, t in made_texts(seed)] + [(None, "g0w0 g0w1 g0w2"), (3, "a b"), (3, "a b c d e f")]
    df = spark.createDataFrame([(*r, b"k", 1, 2) for r in rows], "doc_id long, text string, key binary, size int, row long")
    found = set_join.similar_components(df)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_components(rows)


def test_no_components(no_docs):
    assert set_join.similar_components(no_docs).collect() == []


def test_bitmaps_bound_the_overlap():
    random_numbers = np.random.default_rng(5)
    for _ in range(200):
        n, shared = int(random_numbers.integers(1, 400)), 0
        pool = np.unique(random_numbers.integers(-(1 << 62), 1 << 62, 2 * n))
        a, b = np.sort(random_numbers.choice(pool, n, replace=False)), np.sort(random_numbers.choice(pool, n, replace=False))
        shared = len(np.intersect1d(a, b))
        for bits in (64, 1024):
            differing = np.bitwise_count(set_join.bitmap(a, bits) ^ set_join.bitmap(b, bits)).sum()
            assert shared <= (2 * n - differing) // 2
        wide, narrow = set_join.bitmap(a, 1024), set_join.bitmap(a, 64)
        assert (set_join.folded(wide, 1) == narrow).all()
        if 100 * shared >= 80 * (2 * n - shared):
            assert set_join.may_link(np.int64(n), np.int64(n), differing)


def test_bands_hold_the_ratio():
    sizes = np.arange(1, 3000)
    for s in sizes.tolist():
        largest = s * 100 // 80
        assert set_join.ratio_band(np.array([largest]))[0] - set_join.ratio_band(np.array([s]))[0] in (0, 1)


# ---- 13: centroids -------------------------------------------------------------------------


def brute_clusters(rows, k, rounds, components, scale=256, seed=2):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == components and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, [int(np.floor(scale * x)) for x in v]))
    ranked = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centers = [v for _i, v in ranked[:k]]

    def assign():
        return [min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centers)) for _i, v in kept]

    for _ in range(rounds):
        groups = {}
        for (_d, n), (_i, v) in zip(assign(), kept):
            groups.setdefault(n, []).append(v)
        for n, members in groups.items():
            centers[n] = [sum(x) // len(members) for x in zip(*members)]
    final, out = assign(), []
    for (d, n), (i, _v) in zip(final, kept):
        digest = hashlib.sha256(",".join(map(str, centers[n])).encode()).hexdigest()
        out.append((i, n, d, sum(x for x, m in final if m == n), sum(x for x, _m in final), digest))
    return sorted(out, key=repr)


@pytest.mark.parametrize("n, k", [(60, 5), (3, 5), (0, 5)])
def test_clusters(spark, n, k):
    chance = random.Random(n)
    rows = [(i, [chance.choice([-1.0, 0.0, 1.0]) + chance.gauss(0, 0.2) for _ in range(4)]) for i in range(n)]
    rows += [(r[0], list(r[1])) for r in rows[:7]]  # repeated rows
    rows += [(91, None), (92, []), (93, [1.0, 2.0, None, 3.0]), (94, [1.0, float("nan"), 0.0, 0.0]), (95, [float("inf")] * 4), (96, [0.5] * 5)]
    if n > 5:
        rows += [(None, [0.25, -0.001, 0.0, 3.5]), (97, [0.5, 0.5, 0.5, 0.5]), (98, [0.5, 0.5, 0.5, 0.5])]  # ties, no id
    df = spark.createDataFrame([(*r, 1, 2) for r in rows], "vec_id long, embedding array<double>, cluster int, v int")
    found, _centers = centroids.centroid_clusters(df, k, 3, 4)
    assert sorted(map(tuple, found.collect()), key=repr) == brute_clusters(rows, k, 3, 4)
