"""Documents whose sets of word shingles overlap enough, and the groups they form.

Sets are arrays of 64-bit shingle hashes in ascending order, each with a bitmap signature: bit h(x) mod m
flips for every member x. Bits in which two bitmaps differ are at most as many as members only one set has,
so their count bounds the overlap from above without a look at the sets. m grows with the set, and a wide bitmap
folds to a narrow one, so long documents are told apart as well as short ones.

Sets can only link when their sizes are within the ratio of the similarity, so sizes are cut into bands of
that ratio and a set meets its own band and the next one. Within them, two sets that link share a
member among the first of each in any fixed order of all shingles (prefix filter). A tile is such a shingle
and a size band. The order is that of the hashes, but among the smallest ones (the region) shingles of many documents
come last, so that tiles stay small. The order changes which sets meet, never which link. Only the region of a set is
stored and counted; whole arrays are made again from the texts of those documents that have a candidate.

Equal sets are one node. In a tile every node is compared with one center first, the node that most others meet; nodes that
this joins to one component need no comparison among themselves. The rest is compared block by block:
only with nodes of other components, only within the size ratio, and by bitmaps. What these let pass is verified by
exact intersection of the sorted arrays. The center's array travels once for many partners, not once per pair.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.near_dedup import components
from tillstream.llm.registry import query, stored, table
from tillstream.llm.words import mixed, pieces, rows_of_words, text_buffer, whole_windows, window_hashes, word_hashes, word_spans

#: words of a shingle; percent of the union that the intersection must be
WORDS, PERCENT = 5, 80
#: share of all hash values that make the region; more than the share of a set that is looked at
REGION = 0.3
#: documents of a shingle above which it goes to the end of the region, and how many shingles do at most:
#: both change the order only, and bound what is broadcast to 9 MB
HOT, HOT_LIST = 16, 1 << 20
#: nodes of a tile that are compared within one group, and partners of a node that are verified in one
BLOCK, PARTNERS = 2048, 4096
#: pairs of rows whose bitmaps are compared in one step
AT_ONCE = 1 << 15


# ---- sets ----------------------------------------------------------------------------------


def distinct_shingles(data: np.ndarray, offsets: np.ndarray, size: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """(values, row offsets): the distinct shingles of each text as ascending hashes. A text of fewer words than
    a shingle is one shingle; a text without words has none. A-Z count as a-z."""
    lowered = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)
    starts, ends, first = word_spans(lowered, offsets)
    words = word_hashes(lowered, starts, ends)
    row = rows_of_words(first)
    at = np.flatnonzero(whole_windows(row, size))
    hashes, rows = window_hashes(words, size)[at], row[at]
    counts = np.diff(first)
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            # The seed differs, so a short text is no shingle of a longer one.
            hashes = np.concatenate([hashes, mixed(window_hashes(words, n)[first[short]] + np.uint64(n))])
            rows = np.concatenate([rows, short])
    values = hashes.view(np.int64)
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    new = np.ones(len(rows), dtype=bool)
    new[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    return values[new], np.searchsorted(rows[new], np.arange(len(offsets)))


def ratio_band(size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Sizes whose ratio is `percent` or more are in one band or in neighbouring ones."""
    return np.floor(np.log(size) / math.log(100 / percent)).astype(np.int64)


def bitmap_bits(band: int, percent: int = PERCENT, each: int = 4) -> int:
    """Bits of the bitmaps of a band, a power of two: at least `each` for each member. With four, hardly a
    set below the similarity passes; with two, few do, and what is compared in tiles stays short."""
    return max(64, 1 << math.ceil(math.log2(each * (100 / percent) ** min(band, 200))))


def bitmap(values: np.ndarray, bits: int) -> np.ndarray:
    """The parity of the members at every bit, in 64-bit words."""
    at = mixed(values.view(np.uint64)) & np.uint64(bits - 1)
    odd = (np.bincount(at.astype(np.int64), minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<u8")


def folded(words: np.ndarray, length: int) -> np.ndarray:
    """A bitmap with `length` words: halves are laid over one another."""
    while len(words) > length:
        words = words[: len(words) // 2] ^ words[len(words) // 2 :]
    return words


def prefix_length(size: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """How many first members of a set must be looked at to find every link."""
    return size - (percent * size + 99) // 100 + 1


#: hash values below this are in the region
REGION_END = np.int64(int(REGION * (1 << 64)) - (1 << 63))

SETS = "row long, doc_id long, text_hash long, key binary, size int, bits binary, narrow binary, region array<long>"


def _key(values: np.ndarray) -> bytes:
    """What stands for a set: equal for equal sets only."""
    return hashlib.blake2b(values.tobytes(), digest_size=16).digest()


def _lists(cuts: np.ndarray, values: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(cuts.astype(np.int32)), pa.array(values))


def shingle_sets(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: its number, doc_id, a hash of the text, key (16 bytes that stand for the set),
    size, bitmap, and the region: the members below REGION_END, or as many as must be looked at."""
    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            for low, high in pieces(offsets):
                values, cut = distinct_shingles(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], words)
                sizes = np.diff(cut)
                sets = [values[a:b] for a, b in zip(cut, cut[1:])]
                bands = ratio_band(np.maximum(sizes, 1), percent).tolist()
                looked = np.where(sizes > 0, prefix_length(sizes, percent), 0)
                regions = [x[: max(int(np.searchsorted(x, REGION_END)), n)] for x, n in zip(sets, looked.tolist())]
                bits = [bitmap(x, bitmap_bits(b, percent)) for x, b in zip(sets, bands)]
                narrow = [folded(x, bitmap_bits(b, percent, 2) // 64) for x, b in zip(bits, bands)]
                columns = [
                    *(batch.column(c).slice(low, high - low) for c in ("row", "doc_id", "text_hash")),
                    pa.array([_key(x) for x in sets], pa.binary()),
                    pa.array(sizes.astype(np.int32)),
                    pa.array([x.tobytes() for x in bits], pa.binary()),
                    pa.array([x.tobytes() for x in narrow], pa.binary()),
                    _lists(np.concatenate([[0], np.cumsum([len(x) for x in regions])]), np.concatenate([*regions, values[:0]])),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["row", "doc_id", "text_hash", "key", "size", "bits", "narrow", "region"])

    return rows.mapInArrow(make, SETS)


def whole_sets(docs: DataFrame, wanted: DataFrame, words: int = WORDS) -> DataFrame:
    """row and items (all members, ascending) of the wanted rows of `shingle_sets`, made from their texts again."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    known = wanted.select("row", "key", F.col("doc_id").alias("wanted_id"), F.col("text_hash").alias("wanted_hash"))
    same = (F.col("text_hash") == F.col("wanted_hash")) & F.col("doc_id").eqNullSafe(F.col("wanted_id"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_buffer(batch.column("text"))
            keys = batch.column("key").to_pylist()
            for low, high in pieces(offsets):
                values, cut = distinct_shingles(data[offsets[low] : offsets[high]], offsets[low : high + 1] - offsets[low], words)
                good = pa.array([_key(values[a:b]) == k for a, b, k in zip(cut, cut[1:], keys[low:high])])
                found = pa.RecordBatch.from_arrays([batch.column("row").slice(low, high - low), _lists(cut, values)], names=["row", "items"])
                yield found.filter(good)

    made = texts.join(known, same).select("row", "key", "text").mapInArrow(make, "row long, items array<long>")
    return made.groupBy("row").agg(F.first("items").alias("items"))  # repeated rows give one


# ---- tiles ---------------------------------------------------------------------------------


def prefixes(sets: DataFrame, hot: np.ndarray, level: np.ndarray, percent: int = PERCENT) -> DataFrame:
    """item, row, size and band of the first members of every set. `hot` (ascending) are shingles that come
    later in the region, those of a higher level last."""
    sent = sets.sparkSession.sparkContext.broadcast((hot, level))

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot, level = sent.value
        for batch in batches:
            region = batch.column("region")
            values, length = region.flatten().to_numpy(), np.diff(region.offsets.to_numpy()).astype(np.int64)
            row = np.repeat(np.arange(len(length)), length)
            late = np.zeros(len(values), dtype=np.int8)
            if len(hot):
                at = np.minimum(np.searchsorted(hot, values), len(hot) - 1)
                late = np.where(hot[at] == values, level[at], late)
            late[values >= REGION_END] = 127
            order = np.lexsort((values, late, row))
            size = batch.column("size").to_numpy().astype(np.int64)
            rank = np.arange(len(values)) - np.repeat(np.cumsum(length) - length, length)
            at = order[rank < prefix_length(size, percent)[row]]
            rows = batch.column("row").to_numpy()
            columns = [values[at], rows[row[at]], size[row[at]].astype(np.int32), ratio_band(size[row[at]], percent).astype(np.int32)]
            for k in range(0, max(len(at), 1), 1 << 16):
                yield pa.RecordBatch.from_arrays([pa.array(c[k : k + (1 << 16)]) for c in columns], names=["item", "row", "size", "band"])

    return sets.select("row", "size", "region").mapInArrow(take, "item long, row long, size int, band int")


def meeting_rows(sets: DataFrame, nodes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """item, row, size, band and n (the rows that have the item in their region) of all prefix members that several
    nodes have there. Of items with the same rows one stands for all. Copies of a node go here, after the
    members that nobody else has, so that no sets are moved to tell copies from nodes."""
    counts = stored(sets.where("size > 0").select(F.explode("region").alias("item")).groupBy("item").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "counts")
    crowded = counts.where(F.col("n") > HOT).orderBy(F.col("n").desc(), "item").limit(HOT_LIST).toArrow().sort_by("item")
    level = np.floor(np.log2(np.maximum(crowded["n"].to_numpy(), 1))).astype(np.int8)
    rows = prefixes(sets.where("size > 0"), crowded["item"].to_numpy(), level, percent).join(counts, "item")
    rows = stored(rows.join(nodes.select(F.col("node").alias("row")), "row", "left_semi"), "meetings")
    # A passage that the same documents share is many items with the same rows: one of them does.
    same = rows.groupBy("item").agg(F.bit_xor(F.xxhash64("row")).alias("x"), F.bit_xor(F.xxhash64(F.lit(1), "row")).alias("y"), F.count(F.lit(1)).alias("z"))
    one = same.where("z > 1").groupBy("x", "y", "z").agg(F.min("item").alias("item"))
    return stored(rows.join(one.select("item"), "item", "left_semi"), "meetings")


def tiles(meetings: DataFrame) -> DataFrame:
    """Every row in the tile of its own band and, as a guest, in that of the next band."""
    places = F.explode(F.array(F.struct(F.col("band").alias("tile"), F.lit(False).alias("guest")), F.struct((F.col("band") + 1).alias("tile"), F.lit(True).alias("guest"))))
    return meetings.select("item", "row", "size", "n", places.alias("p")).select("item", "row", "size", "n", "p.tile", "p.guest")


def may_link(size_a: np.ndarray, size_b: np.ndarray, differing: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """Whether sets of these sizes, whose bitmaps differ in so many bits, can be similar enough. The overlap is at
    most half of what the sizes exceed the differing bits by."""
    overlap = np.minimum((size_a + size_b - differing) // 2, np.minimum(size_a, size_b))
    return (100 + percent) * overlap >= percent * (size_a + size_b)


def plausible(pairs: DataFrame, sets: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) that sizes and bitmaps leave possible."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = [[np.frombuffer(x, "<u8") for x in batch.column(c).to_pylist()] for c in ("bits_a", "bits_b")]
            sizes = [batch.column(c).to_numpy().astype(np.int64) for c in ("size_a", "size_b")]
            width = [min(len(x), len(y)) for x, y in zip(*bits)]
            differing = [int(np.bitwise_count(folded(x, w) ^ folded(y, w)).sum()) for x, y, w in zip(*bits, width)]
            keep = pa.array(may_link(*sizes, np.array(differing, dtype=np.int64), percent))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in ("a", "b")], names=["a", "b"])

    for side in ("a", "b"):
        facts = sets.select(F.col("row").alias(side), F.col("size").alias(f"size_{side}"), F.col("bits").alias(f"bits_{side}"))
        pairs = pairs.join(facts, side)
    return pairs.mapInArrow(judge, "a long, b long")


def verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) of distinct rows whose sets are similar enough, by exact intersection.

    Partners of a node a are dealt to groups of at most about PARTNERS; a's array goes to each group once.
    """
    load = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / PARTNERS).alias("groups"))
    dealt = pairs.join(load, "a").withColumn("deal", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int")).select("a", "deal", "b")
    needed = pairs.select(F.col("a").alias("row")).union(pairs.select("b")).distinct()
    arrays = stored(whole_sets(docs, sets.join(needed, "row", "left_semi"), words), "arrays")
    own = dealt.select("a", "deal").distinct().withColumn("b", F.col("a"))
    both = own.withColumn("partner", F.lit(False)).unionByName(dealt.withColumn("partner", F.lit(True)))
    both = both.join(arrays.withColumnRenamed("row", "b"), "b").repartition("a", "deal").sortWithinPartitions("a", "deal", "partner")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, known = None, np.zeros(0, dtype=np.int64)
        for batch in batches:
            out = []
            items = batch.column("items")
            values, cut = items.flatten().to_numpy(), np.concatenate([[0], np.cumsum(np.diff(items.offsets.to_numpy()))])
            for k, (a, b, partner) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("a", "b", "partner")))):
                these = values[cut[k] : cut[k + 1]]
                if not partner:
                    held, known = a, these.copy()
                    continue
                if held != a:
                    raise RuntimeError("a partner came before its node")
                at = np.minimum(np.searchsorted(known, these), len(known) - 1)
                shared = int((known[at] == these).sum())
                if 100 * shared >= percent * (len(known) + len(these) - shared):
                    out.append((a, b))
            columns = list(zip(*out)) or [[], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

    return both.select("a", "b", "partner", "items", "deal").mapInArrow(compare, "a long, b long")


def blocked(rows: DataFrame) -> DataFrame:
    """Rows (item, tile, row, size, guest, root, main) dealt to groups (item, tile, i, j) in which blocks meet.

    `main` says that a row is of the tile's main component: such rows need not meet one another. The others'
    blocks meet all blocks, so a tile costs what lies outside its main component times its rows.
    """
    counts = rows.groupBy("item", "tile").agg(F.ceil(F.count_if(~F.col("main")) / BLOCK).alias("others"), F.ceil(F.count_if("main") / BLOCK).alias("mains"))
    counts = counts.where("others > 0")
    drawn = F.pmod(F.xxhash64("row"), F.when(F.col("main"), F.col("mains")).otherwise(F.col("others")))
    block = (F.when(F.col("main"), F.col("others")).otherwise(F.lit(0)) + drawn).cast("int")
    most = F.when(F.col("main"), F.col("others")).otherwise(F.col("others") + F.col("mains")).cast("int")
    dealt = rows.join(counts, ["item", "tile"]).withColumns({"block": block, "other": F.explode(F.sequence(F.lit(0), most - 1))})
    return dealt.select("item", "tile", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "row", "size", "guest", "root")


def compared(dealt: DataFrame, percent: int = PERCENT, best: bool = False) -> DataFrame:
    """Pairs (a, b) of one group that have different roots and that sizes and bitmaps leave possible; with `best`
    only the most promising one of each node."""
    keys = ["item", "tile", "i", "j"]

    def pairs(group: list[dict]) -> tuple[np.ndarray, np.ndarray]:
        size = np.concatenate([g["size"] for g in group]).astype(np.int64)
        order = np.argsort(size, kind="stable")
        size = size[order]
        row, root, block, guest = (np.concatenate([g[c] for g in group])[order] for c in ("row", "root", "block", "guest"))
        raw = [x for g in group for x in g["narrow"]]
        width = min(map(len, raw)) // 8
        bits = np.stack([folded(np.frombuffer(raw[k], "<u8"), width) for k in order.tolist()])
        across = group[0]["i"][0] != group[0]["j"][0]
        last = np.searchsorted(size, size * 100 // percent, side="right")
        n, found = len(row), [np.zeros((3, 0), dtype=np.int64)]
        step = max(1, AT_ONCE // n)
        for low in range(0, n, step):
            # A stripe of rows against all that sort after them.
            some = np.arange(low, min(low + step, n))
            i, j = np.repeat(some, n - low), np.tile(np.arange(low, n), len(some))
            fit = (j > i) & (j < last[i]) & (root[i] != root[j]) & ~(guest[i] & guest[j])
            if across:
                fit &= block[i] != block[j]
            i, j = i[fit], j[fit]
            differing = np.bitwise_count(bits[i] ^ bits[j]).sum(1, dtype=np.int64)
            fit = may_link(size[i], size[j], differing, percent)
            found.append(np.stack([i[fit], j[fit], differing[fit]]))
        i, j, differing = np.concatenate(found, axis=1)
        if best:
            # Of each row the partner that differs least.
            mine, other, d = np.concatenate([i, j]), np.concatenate([j, i]), np.concatenate([differing, differing])
            order = np.lexsort((other, d, mine))
            first = order[np.unique(mine[order], return_index=True)[1]]
            i, j = mine[first], other[first]
        return np.minimum(row[i], row[j]), np.maximum(row[i], row[j])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        out: list[tuple[np.ndarray, np.ndarray]] = []

        def made() -> pa.RecordBatch:
            columns = [np.concatenate([*x, np.zeros(0, dtype=np.int64)]) for x in (zip(*out) if out else ((), ()))]
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in [*keys, "block", "row", "size", "guest", "root"]}
            columns["narrow"] = batch.column("narrow").to_pylist()
            change = np.flatnonzero(np.any([columns[c][1:] != columns[c][:-1] for c in keys], axis=0)) + 1
            for low, high in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
                part = {c: x[low:high] for c, x in columns.items()}
                if held and any(held[0][c][0] != part[c][0] for c in keys):
                    out.append(pairs(held))
                    held = []
                held.append(part)
            yield made()
        if held:
            out.append(pairs(held))
            yield made()

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(compare, "a long, b long").distinct()


# ---- the join ------------------------------------------------------------------------------


def _open_rows(placed: DataFrame, centers: DataFrame, roots: DataFrame) -> DataFrame:
    """The rows, with root and main, of the tiles in which nodes of several components meet."""
    rooted = placed.join(roots.withColumnRenamed("node", "row"), "row", "left").withColumn("root", F.coalesce("root", "row"))
    middle = centers.join(roots.withColumnRenamed("node", "center"), "center", "left")
    middle = middle.select("item", "tile", F.coalesce("root", "center").alias("middle"))
    rooted = rooted.join(middle, ["item", "tile"]).withColumn("main", F.col("root") == F.col("middle"))
    rooted = stored(rooted.select("item", "tile", "row", "size", "guest", "root", "main"), "rooted")
    tile = rooted.groupBy("item", "tile").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.count(F.lit(1)).alias("members"))
    tile = tile.where("low <> high and members > 2").select("item", "tile")
    return rooted.join(tile, ["item", "tile"])


def similar_components(docs: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """One row per input row: doc_id, n_shingles (the size of its set), component_id (the smallest doc_id that
    links lead to, its own included) and n_rows (the rows of the component).

    A-Z count as a-z; words are what stands between blanks. A document's set are its distinct shingles of
    `words` words, whole texts of any length; with fewer words the whole sequence is one. Two rows link if the
    intersection is `percent` percent of the union or more. Null texts and texts without words have an empty
    set and link with nothing, not even each other. Rows are taken one by one, also if they share a doc_id; repeated rows
    link by their equal sets. Rows without doc_id link like all others; the component of nothing but such
    rows is null. An empty table gives no rows. Other columns are ignored.
    """
    sets = stored(shingle_sets(docs, words, percent), "sets")
    keys = sets.where("size > 0").groupBy("key").agg(F.min("row").alias("node"), F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows"))
    nodes = stored(keys, "nodes")
    meetings = meeting_rows(sets, nodes, percent)
    popular = meetings.groupBy("row").agg(F.sum("n").alias("popularity"))
    ranked = F.struct("popularity", (-F.col("row")).alias("minus"))
    owned = meetings.join(popular, "row").groupBy("item", F.col("band").alias("tile"))
    centers = stored(owned.agg(F.max_by("row", ranked).alias("center")), "centers")
    placed = tiles(meetings)
    spokes = placed.join(centers, ["item", "tile"]).where("row <> center").select(F.col("center").alias("a"), F.col("row").alias("b")).distinct()
    first = stored(plausible(spokes, sets, percent), "spokes")
    links = stored(verified(first, sets, docs, words, percent), "links")

    # Tiles that still hold several components, and more than the center and one partner. The most promising pairs
    # come first: they spare the many others between two nodes' components.
    tried = first.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    for best in (True, False):
        dealt = blocked(_open_rows(placed, centers, components(links))).join(sets.select("row", "narrow"), "row")
        pairs = compared(dealt, percent, best).join(tried, ["a", "b"], "left_anti")
        pairs = stored(plausible(pairs, sets, percent), "pairs")
        links = links.unionByName(stored(verified(pairs, sets, docs, words, percent), "links"))
        tried = tried.unionByName(pairs)

    found = nodes.join(components(links).select("node", "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    totals = found.groupBy("root").agg(F.min("least").alias("component"), F.sum("rows").alias("n_rows"))
    by_key = stored(found.join(totals, "root").select("key", "component", "n_rows"), "by-key")
    out = sets.select("doc_id", "size", F.when(F.col("size") > 0, F.col("key")).alias("key")).join(by_key, "key", "left")
    return out.select(
        "doc_id",
        F.col("size").cast("long").alias("n_shingles"),
        F.coalesce("component", "doc_id").alias("component_id"),
        F.coalesce("n_rows", F.lit(1)).alias("n_rows"),
    )


SQL = r"""
with recursive words as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w
  from documents
), sets as materialized (
  select doc_id, list_distinct(case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')]
         else list_transform(range(1, len(w) - 3), lambda p: array_to_string(list_slice(w, p, p + 4), ' ')) end) as s
  from words
), members as materialized (select doc_id, len(s) as n, unnest(s) as x from sets
), common as (
  select a.doc_id as a, b.doc_id as b, any_value(a.n) as n, any_value(b.n) as m, count(*) as k
  from members a join members b on a.x = b.x and a.doc_id <> b.doc_id group by 1, 2
), links as materialized (select a, b from common where 100 * k >= 80 * (n + m - k)
), reach as (
  select doc_id, doc_id as other from sets
  union select reach.doc_id, links.b from reach join links on links.a = reach.other
)
select doc_id, any_value(len(s)) as n_shingles, min(other) as component_id, count(*) as n_rows from reach join sets using (doc_id) group by doc_id
"""


@query("op12_set_join", SQL)
def op12_set_join(spark, sf_dir):
    """The component of every document."""
    return similar_components(table(spark, sf_dir, "documents"))
