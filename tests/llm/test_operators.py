"""Each operator against brute force, and on odd rows and empty tables."""

import base64
import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import tiktoken
from conftest import SF_DIR
from tokenizers import Tokenizer

from tillstream.llm import (
    byte_bpe,
    chunk_dedup,
    decontamination,
    licenses,
    near_dedup,
    sharding,
    substring,
    token_files,
    toxicity,
)
from tillstream.llm.main_text import extract_pages, main_blocks
from tillstream.llm.words import text_buffer


TEXTS = [
    (1, "The quick brown fox, jumps over the lazy dog again"),
    (2, "The quick brown fox, jumps over the lazy dog again"),
    (3, "THE QUICK brown fox, jumps over the lazy dog again"),
    (4, None),
    (5, ""),
    (6, "one"),
    (7, "  \n\t "),
    (8, "Ünïcödé wörds – and 数字 12 😀 it's done.\x1c next"),
    (9, " ".join(f"w{i % 97}x{i}" for i in range(3000))),
    (10, "same same same same same same same same same same"),
    (10, "same same same same same same same same same same"),
    (None, "a row without an id"),
]


@pytest.fixture(scope="session")
def docs(spark):
    """Nulls, empty and long texts, ties, repeated rows, and extra columns with clashing names."""
    rows = [(i, t, "x", 1, "y", 0.5, b"k") for i, t in TEXTS]
    schema = "doc_id long, text string, source string, shard int, part string, score double, key binary"
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def no_docs(docs):
    return docs.limit(0)


def table(spark, name):
    return spark.read.parquet(f"{SF_DIR}/{name}.parquet")


def given(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# ---- 10: repeats ---------------------------------------------------------------------------


def brute_repeats(rows, size):
    words = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    least = {}
    for i, w in words:
        for p in range(len(w) - size + 1):
            key = tuple(w[p : p + size])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    out = []
    for i, w in words:
        gone = set()
        for p in range(len(w) - size + 1):
            if i is not None and least[tuple(w[p : p + size])] < i:
                gone.update(range(p, p + size))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("size, part_bytes", [(4, 1 << 20), (4, 40), (5, 200)])
def test_repeats(spark, docs, size, part_bytes):
    chance = random.Random(size)
    vocabulary = ["a", "bb", "c,", "Dd"]
    made = [(i, " ".join(chance.choices(vocabulary, k=chance.randint(0, 30)))) for i in range(100, 140)]
    rows = given(docs) + made
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = substring.remove_repeats(df, size, part_bytes).select("doc_id", "n_words", "n_removed", "kept").collect()
    assert sorted(map(tuple, found), key=repr) == brute_repeats(rows, size)


def test_repeats_of_nothing(no_docs):
    assert substring.remove_repeats(no_docs).collect() == []


# ---- 6: exact duplicates -------------------------------------------------------------------


def test_exact_groups(docs, no_docs):
    found = chunk_dedup.duplicate_groups(docs).collect()
    rows = [(i, re.sub("[A-Z]", lambda m: m.group().lower(), t or "")) for i, t in given(docs)]
    expected = []
    for i, t in rows:
        ids = [j for j, u in rows if u == t]
        keep = max((j for j in ids if j is not None), default=None)
        expected.append((i, keep, len(ids), i == keep, hashlib.sha256(t.encode()).hexdigest()))
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)
    assert chunk_dedup.duplicate_groups(no_docs).collect() == []


def test_chunks_depend_on_the_text_only():
    chance = np.random.default_rng(1)
    text = chance.integers(97, 123, 50_000).astype(np.uint8)
    alone = chunk_dedup.cuts(chunk_dedup.boundaries(text), 0, len(text))
    moved = np.concatenate([chance.integers(97, 123, 777).astype(np.uint8), text])
    assert [c - 777 for c in chunk_dedup.cuts(chunk_dedup.boundaries(moved), 777, len(moved))] == alone
    assert max(np.diff([0, *alone])) <= chunk_dedup.MOST


# ---- 2: shards -----------------------------------------------------------------------------


def least_largest(sizes, shards):
    def fits(capacity):
        n, used = 1, 0
        for s in sizes:
            if s > capacity:
                return False
            if used + s > capacity:
                n, used = n + 1, 0
            used += s
        return n <= shards

    low, high = max(sizes), sum(sizes)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


@pytest.mark.parametrize("shards", [1, 3, 40])
def test_shards(spark, docs, no_docs, shards):
    rows = given(docs) + given(table(spark, "documents"))[:60]
    found = sharding.assign_shards(spark.createDataFrame(rows, "doc_id long, text string"), shards).collect()
    assert len(found) == len(rows)
    first, size = {}, Counter()
    for i, t in rows:
        t = t or ""
        if t not in first or (i is not None and (first[t] is None or i < first[t])):
            first[t] = i
        size[t] += len(t.encode()) + 16
    ordered = sorted(first, key=lambda t: (first[t] is not None, first[t] or 0, hashlib.sha256(t.encode()).digest()))
    loads, slots = Counter(), {}
    for r in found:
        loads[r["shard"]] += r["size"]
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(loads.values()) == least_largest([size[t] for t in ordered], shards)
    assert sharding.assign_shards(no_docs, shards).collect() == []


def test_line_is_refined(monkeypatch):
    """With a coarse index the search must refine, and still finds the best capacity."""
    monkeypatch.setattr(sharding, "RUNS", 3)
    chance = random.Random(5)
    sizes = [chance.randint(1, 900) for _ in range(400)]
    ends = np.cumsum(sizes).tolist()

    def fetch(ranges):
        out = {}
        for k, (low, high) in enumerate(ranges):
            step = max(1, -(-(high - low) // 4))
            for e in ends:
                if low < e <= high:
                    out.setdefault((k, (e - low - 1) // step), []).append(e)
        return [(min(v), max(v), len(v)) for v in out.values()]

    line = sharding.Line(ends[-1], fetch)
    assert sharding.least_capacity(line, 17, max(sizes)) == least_largest(sizes, 17)


# ---- 8 and 9: tokens -----------------------------------------------------------------------


def test_byte_bpe(docs, no_docs):
    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    plain = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for r in byte_bpe.detokenize(byte_bpe.tokenize(docs)).collect():
        assert r["ids"] == plain.encode_ordinary(r["text"] or "")
        assert bytes(r["raw"]) == (r["text"] or "").encode()
    assert byte_bpe.detokenize(byte_bpe.tokenize(no_docs)).collect() == []


def test_cut_keeps_the_tokens():
    text = " ".join(f"word{i}, it's  {i}\n\n" for i in range(500)) + "x" * 300 + "   "
    pieces = byte_bpe.cut(text, 50)
    assert "".join(pieces) == text and len(pieces) > 100
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    whole = byte_bpe.encoding(path, pattern).encode_ordinary(text)
    assert [i for p in pieces for i in byte_bpe.encode_text(p, path, pattern)] == whole


@pytest.mark.parametrize("bits", [1, 7, 13, 16, 17, 31])
def test_packing(bits):
    chance = np.random.default_rng(bits)
    ids = chance.integers(0, 1 << bits, 1000).astype(np.uint32)
    page = token_files.write_page([ids[:300], ids[300:300], ids[300:]], bits)
    assert (token_files.read_ids(page) == ids).all()
    for low, high in ((0, 1), (63, 65), (128, 700), (999, 1000), (500, 500)):
        assert (token_files.read_ids(page, low, high) == ids[low:high]).all()


def test_token_files(spark, docs, no_docs, tmp_path):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    odd = [(20, "É É H̱ Å.,! it's <|endoftext|> IİΣς ﬁ"), (21, "don't... stop!Now 12.5,x")]
    rows = given(docs) + odd
    folder = str(tmp_path / "tokens")
    token_files.write_tokens(spark.createDataFrame(rows, "doc_id long, text string"), folder, part_bytes=4000)
    found = token_files.read_tokens(spark, folder)
    found = found.withColumn("crc", token_files.crc32_of_ids("ids")).orderBy("start").collect()
    assert [r["doc_id"] for r in found] == sorted((i for i, _ in rows), key=lambda i: (i is not None, i or 0))
    start, texts = 0, Counter((i, t or "") for i, t in rows)
    ids_of = {(i, tuple([*library.encode(t, add_special_tokens=False).ids, 2])) for i, t in texts}
    for r in found:
        assert r["start"] == start and (r["doc_id"], tuple(r["ids"])) in ids_of
        assert r["crc"] == zlib.crc32(np.array(r["ids"], dtype="<u4").tobytes())
        start += r["n_tokens"]
    empty = str(tmp_path / "none")
    token_files.write_tokens(no_docs, empty)
    assert token_files.read_tokens(spark, empty).collect() == []


def test_long_runs_of_blanks():
    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    plain = byte_bpe.encoding(path, pattern)
    for text in ("a" + " " * 90_000 + "b c", " " * 90_000, "x\n" + "\n\t " * 30_000 + "é", "a " * 10 + "\u3000" * 60_000 + ".", "1" + " " * 60_000 + "\x1c2"):
        assert byte_bpe.encode_text(text, path, pattern) == plain.encode_ordinary(text)
    long = "word" + " " * 2_000_000 + "end"
    ids = byte_bpe.encode_text(long, path, pattern)
    assert plain.decode_bytes(ids) == long.encode()


# ---- 7: near duplicates --------------------------------------------------------------------


def brute_similarity(a, b):
    def weights(t):
        w = re.sub(r"[\W_]+", " ", (t or "").lower()).split()
        return Counter(tuple(w[k : k + 5]) for k in range(len(w) - 4)) or Counter([tuple(w)] if w else [])

    x, y = weights(a), weights(b)
    if not x and not y:
        return 1.0
    every = x.keys() | y.keys()
    return sum(1 / sum(max(x[k] / x[s], y[k] / y[s]) for k in every) for s in x.keys() & y.keys())


def test_near_duplicates(spark, docs, no_docs):
    chance = random.Random(3)
    rows = given(docs)
    for group in range(6):
        words = [f"g{group}w{chance.randint(0, 300)}" for _ in range(200)]
        for copy in range(8):
            edited = list(words)
            for _ in range(copy):
                edited[chance.randrange(200)] = f"e{chance.random()}"
            rows.append((100 + group * 8 + copy, " ".join(edited)))
    found = near_dedup.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    root = {i: i for i, _ in rows if i is not None}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    known = [r for r in rows if r[0] is not None]
    for k, (i, t) in enumerate(known):
        for j, u in known[:k]:
            if brute_similarity(t, u) >= 0.8 - 1e-9:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    assert sorted((r["doc_id"], r["class_id"]) for r in found if r["doc_id"]) == sorted((i, find(i)) for i, _ in known)
    assert [r["kept"] for r in found if r["doc_id"] is None] == [True]
    assert near_dedup.near_duplicate_classes(no_docs).collect() == []


def test_near_duplicates_of_repetitive_texts(spark):
    """Few changed words in a repeated line add many distinct shingles, but hardly any weight."""
    line = [f"r{k}" for k in range(12)]
    changed = line * 40
    changed[100], changed[300] = "x", "y"
    rows = [(1, " ".join(line * 40)), (2, " ".join([*line * 40, *(f"t{k}" for k in range(6))])), (3, " ".join(changed)), (4, " ".join(f"z{k}" for k in range(480)))]
    for k in (1, 2):
        counts = [len(near_dedup.shingles(*text_buffer(pa.array([t])))[0]) for t in (rows[0][1], rows[k][1])]
        assert min(counts) < 0.8 * max(counts) and brute_similarity(rows[0][1], rows[k][1]) > 0.95
    found = near_dedup.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["class_id"], r["kept"]) for r in found) == [(1, 1, True), (2, 1, False), (3, 1, False), (4, 4, True)]


def test_near_duplicates_of_further_texts(spark):
    """Each text of a doc_id can link it with others, not only its largest one."""
    texts = [[f"{c}{k}" for k in range(100)] for c in "abc"]
    near = [[*t[:50], "new", *t[51:]] for t in texts]
    rows = [(5, " ".join(t)) for t in texts] + [(k, " ".join(t)) for k, t in zip((2, 7, 8), near)] + [(9, " ".join(f"z{k}" for k in range(100)))]
    found = near_dedup.near_duplicate_classes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r["doc_id"], r["class_id"], r["class_size"]) for r in found) == [(i, 2, 6) for i in (2, 5, 5, 5, 7, 8)] + [(9, 9, 1)]


def test_signatures_estimate_the_similarity():
    chance = random.Random(2)
    a = [f"w{chance.randint(0, 60)}" for _ in range(300)]
    b = a[:240] + [f"v{k}" for k in range(60)]
    import pyarrow as pa

    from tillstream.llm.words import text_buffer

    data, offsets = text_buffer(pa.array([" ".join(a), " ".join(b)]))
    found = near_dedup.shingles(data, offsets)
    two = near_dedup.signatures(*found, 2, 3989)
    assert abs((two[0] == two[1]).mean() - brute_similarity(" ".join(a), " ".join(b))) < 0.04


# ---- 1: contamination ----------------------------------------------------------------------


def test_contamination(spark, docs, no_docs):
    item = [f"q{k}" for k in range(40)]
    other = [f"z{k}" for k in range(40)]
    benchmark = spark.createDataFrame([(1, " ".join(item)), (2, None), (3, "too short"), (4, " ".join(other))], "item_id long, text string")
    filler = [f"f{k}" for k in range(50)]
    rows = [
        (1, " ".join([*filler, *item, *filler])),
        (2, " ".join([*item[20:40], *filler, *item[:20]]).upper()),  # reordered
        (3, " ".join([*filler, *item[:15], *filler])),  # too little
        (4, " ".join([*item[:12], *filler, *item[:12]])),  # one stretch twice is covered once
        (5, None),
        (6, " ".join([*item, *other])),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = [(1, 1, 40), (2, 1, 40), (6, 1, 40), (6, 4, 40)]
    for block_words in (1 << 20, 10):
        found = decontamination.contaminations(df, benchmark, block_words=block_words)
        assert sorted(map(tuple, found.select("doc_id", "item_id", "n_covered").collect())) == expected
    assert decontamination.contaminations(no_docs, benchmark).collect() == []
    assert decontamination.contaminations(docs, benchmark.limit(0)).collect() == []
    assert decontamination.contaminations(docs, benchmark).collect() == []


def test_contamination_by_short_items(spark):
    items = [(1, "short question here"), (2, "Why?"), (3, "one two three four"), (4, "a b c d e")]
    rows = [(1, "Is this a short question, here?"), (2, "question short here, one two three"), (3, "one two three four five; a b c d"), (4, "why why"), (5, "short question"), (6, "A b c d e")]
    found = decontamination.contaminations(
        spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    )
    columns = ["doc_id", "item_id", "coverage", "n_item_words", "n_covered"]
    assert sorted(map(tuple, found.select(columns).collect())) == [(1, 1, 1.0, 3, 3), (3, 3, 1.0, 4, 4), (4, 2, 1.0, 1, 1), (6, 4, 1.0, 5, 5)]


# ---- 5: licenses ---------------------------------------------------------------------------


def test_licenses(spark, docs, no_docs):
    templates = licenses.template_table(spark)
    filler = " ".join(f"f{k}" for k in range(70))
    rows = [(10 + k, f"{filler} {t} {filler}") for k, t in enumerate(licenses.TEMPLATES.values())]
    rows += [(1, None), (2, ""), (3, "license"), (4, licenses.TEMPLATES["MIT"].replace("charge", "cost")), (5, "Permission is hereby granted")]
    found = {(r["doc_id"], r["license"]) for r in licenses.license_matches(spark.createDataFrame(rows, "doc_id long, text string"), templates).collect()}

    def runs(t):
        w = re.sub(r"[\W_]+", " ", (t or "").lower()).split()
        return {tuple(w[k : k + 3]) for k in range(len(w) - 2)}

    expected = {(i, n) for i, t in rows for n, m in licenses.TEMPLATES.items() if len(runs(m) & runs(t)) >= 0.8 * len(runs(m))}
    assert found == expected and (4, "MIT") in found
    assert licenses.license_matches(no_docs, templates).collect() == []
    assert licenses.license_matches(docs, templates).collect() == []


# ---- 3: toxicity ---------------------------------------------------------------------------


def test_toxicity(spark, docs, no_docs):
    labels = table(spark, "labels")
    made = [(i, ("idiot " if i % 4 == 0 else "") + ("grumfel" + "xyzuvw"[i % 6] + " " if i % 4 == 1 else "") + f"plain words {i} here") for i in range(400)]
    df = spark.createDataFrame(made, "doc_id long, text string")
    marks = spark.createDataFrame([(i, int(i % 4 < 2)) for i, _ in made], "doc_id long, toxic int")
    model = toxicity.fit(df, marks)
    held = toxicity.scored(df, model).where(toxicity.in_held_out("doc_id")).collect()
    assert len(held) > 40 and all(r["predicted"] == int(r["doc_id"] % 4 < 2) for r in held)
    # A stem that clean texts have once counts where it comes up often, in proportion to the length.
    voters = toxicity.Voters(["achl#", "achl+", "idiot*"])
    assert toxicity.terms_in("achla achlb") >= {"achl#", "achl+", "achla"} and "achl#" not in toxicity.terms_in("achla und achl")
    assert voters.row("achla und achlb")[:4] == ([0, 1], 1, 2, 3) and voters.row("achla und achl")[:4] == ([1], 1, 1, 3)
    assert voters.row("achla achlb " + "und " * 900)[:4] == ([1], 1, 2, 902) and voters.row(None)[:4] == ([], 0, 0, 0)
    for fitted in (model, toxicity.fit(no_docs, labels), toxicity.fit(docs, marks.limit(0))):
        scores = toxicity.scored(docs, fitted).collect()
        assert len(scores) == 12 and all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in scores)
        assert toxicity.scored(no_docs, fitted).collect() == []


# ---- 4: pages ------------------------------------------------------------------------------


def test_pages(spark):
    page = """<html><head><title>x</title></head><body><header><h1>Site</h1></header><div class='cookie-notice'>We, use, cookies</div>
    <div id=menu><a href=1>a</a></div><div class="content"><h1>Title &amp; more</h1><p>First, para, with <a href=x>link</a> text, and <b>bold
    words</b><p>Second&nbsp;para, <br>ok<ul><li>item one<li>item two</ul><div class="sidebar">x, y, z</div><script>if (a<b) x("</div>")</script>
    <form><p>sign, up<input></form><section id="comments"><p>nice, post, really</p></section></div><aside>side</aside><footer>c</footer></body>"""
    text = ["Title & more", "First, para, with link text, and bold words", "Second para, ok", "item one", "item two"]
    assert main_blocks(page) == text
    assert main_blocks(None) == main_blocks("") == main_blocks("<p> </p>") == []
    assert main_blocks("<div>" * 3000 + "deep, text") == ["deep, text"]
    assert main_blocks("<p>1 < 2 &lt; 3</p><!-- cut") == ["1 < 2 < 3"]
    assert main_blocks("<article><section><p>long, long, long text</p></section><section><p>b</p></section></article>") == ["long, long, long text", "b"]
    df = spark.createDataFrame([(1, "u", page, "clash"), (2, "u", None, "c")], "page_id long, url string, html string, text string")
    assert [r["text"] for r in extract_pages(df).orderBy("page_id").collect()] == ["\n".join(text), ""]
    assert extract_pages(df.limit(0)).collect() == []
