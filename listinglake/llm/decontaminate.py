"""Benchmark decontamination (operator 8), with built-in expressions only.

Words are runs of letters and digits, lower-cased; features are shingles of five words (of all words
where an item has fewer). Documents are looked at in windows as long as a benchmark item, at every
word. Similarity s of a window of a shingles and an item of b needs a common part of
ceil(s * (a + b) / (1 + s)) shingles, so only windows with as many shingles of items of their length
are taken further; they are read off the sorted places of these shingles, without looking at the
others.

They get a SimHash, and a multi-index of ``BLOCKS`` blocks of the 64 bits finds every pair of window and
item within ``RADIUS`` bits: some block differs in at most ``RADIUS`` // ``BLOCKS`` bits, and an item
stands in the index under every value that near to its own. Candidates are verified by the exact
weighted similarity of their shingles, sum of minima over sum of maxima of the counts.

The radius: without repeated shingles the common part makes the cosine at least 0.889 at a similarity
of 0.8, so each bit differs with probability 0.152 at most, and more than 24 of 64 in fewer than one
pair in 100,000 at the very edge. Repeated shingles weigh more in a SimHash than in the similarity;
pairs with some in the window or the item therefore do not rely on it: they also meet over the item's
first shingles in hash order, of which a similar window has at least one (their number is the item's
less the least common part, and one), and go to the same exact check.

Defined results: null or empty texts have no words and match nothing, neither do such items; an item
longer than the whole document is compared with the whole document; equal items are reported each;
repeated rows of one (doc_id, text) are one document here and all go or all stay; null doc_ids are
compared as equal; an empty table on either side gives no matches; ids keep their type; other columns
are never read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import counted_broadcast, keyed_join, packed, stored, text_hash, unpacked

SHINGLE, SIMILARITY = 5, 0.8
RADIUS, BLOCKS = 24, 5


def words(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def shingles(text: Column, k: int) -> Column:
    """Hash of every k consecutive words of a text (fewer than k words: none). The word hashes are bound
    by an outer lambda, so that they are made once for a text and not once for a word."""
    def runs(wh):
        def at(x, i):
            return F.xxhash64(x, *[F.get(wh, i + j) for j in range(1, k)])
        return F.slice(F.transform(wh, at), F.lit(1), F.greatest(F.size(wh) - (k - 1), F.lit(0)))
    return F.get(F.transform(F.array(F.transform(words(text), lambda w: F.xxhash64(w))), runs), 0)


def simhash(df: DataFrame, keys: list[str], features: str) -> DataFrame:
    """keys, fp: bit set in over half of the feature hashes of the row. Counts of bits j and j + 32
    share a 64-bit sum."""
    lane = F.lit(0x0000000100000001)
    rows = df.select(*keys, F.explode(features).alias("h"))
    sums = [F.sum(F.shiftrightunsigned("h", j).bitwiseAND(lane)).alias(f"s{j}") for j in range(32)]
    counted = rows.groupBy(*keys).agg(F.count("*").alias("n"), *sums)
    low = F.lit(0xFFFFFFFF)
    fp = F.lit(0).cast("bigint")
    for j in range(32):
        for bit, count in ((j, F.col(f"s{j}").bitwiseAND(low)), (j + 32, F.shiftrightunsigned(f"s{j}", 32))):
            value = (1 << bit) - (1 << 64 if bit == 63 else 0)
            fp = fp.bitwiseOR(F.when(2 * count > F.col("n"), F.lit(value)).otherwise(F.lit(0).cast("bigint")))
    return counted.select(*keys, fp.alias("fp"))


def tagged(features: Column) -> Column:
    """Every occurrence of a hash made distinct by its number, so that the common part of two multisets
    is the common part of two sets."""
    return F.get(F.transform(F.array(F.array_sort(features)), lambda s: F.transform(
        s, lambda h, i: F.xxhash64(h, i - F.array_position(s, h)))), 0)


def blocks(fp: Column, near: int = 0) -> Column:
    """array<struct<no, value>>: the blocks of a fingerprint, each with all values within ``near`` bits."""
    edges = [64 * i // BLOCKS for i in range(BLOCKS + 1)]

    def block(i, start, width):
        value = F.shiftrightunsigned(fp, start).bitwiseAND(F.lit((1 << width) - 1))
        flips = F.array(F.lit(0).cast("bigint"))
        if near:
            flips = F.filter(F.sequence(F.lit(0).cast("bigint"), F.lit((1 << width) - 1).cast("bigint")), lambda m: F.bit_count(m) <= near)
        return F.transform(flips, lambda m: F.struct(F.lit(i).alias("no"), value.bitwiseXOR(m).alias("value")))

    return F.concat(*[block(i, a, b - a) for i, (a, b) in enumerate(zip(edges, edges[1:]))])


def index_pairs(windows: DataFrame, items: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Columns of ``windows`` (fp, words and others) and item_id of all pairs of equal ``words`` within
    ``radius`` bits; ``items`` has item_id, words, fp. A pair meets in every block that is near enough and
    is taken at the first of them."""
    near = radius // BLOCKS
    entries = items.select("item_id", "words", F.col("fp").alias("item_fp"), F.explode(blocks(F.col("fp"), near)).alias("b"))
    entries = counted_broadcast(stored(entries.select("item_id", "words", "item_fp", "b.no", "b.value"), "item-blocks"))
    probes = windows.select("*", F.explode(blocks(F.col("fp"))).alias("b")).select(*windows.columns, "b.no", "b.value")
    diff = F.col("fp").bitwiseXOR(F.col("item_fp"))
    first = F.array_position(F.transform(blocks(diff), lambda x: F.bit_count(x["value"]) <= near), True) - 1
    return (probes.join(entries, ["words", "no", "value"])
            .filter((F.bit_count(diff) <= radius) & (F.col("no") == first)).select(*windows.columns, "item_id"))


def matches(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS,
            k: int = SHINGLE) -> DataFrame:
    """doc_id, _th, item_id, start (first word of the best window, from 0), similarity: the best window
    of each document and item with at least this similarity."""
    items = benchmark.select(F.col("item_id"), F.col("text"), F.size(words(F.col("text"))).alias("words"))
    items = items.filter("words > 0")
    items = stored(items.withColumn("k", F.least("words", F.lit(k))), "items")
    out = None
    for (size,) in items.select("k").distinct().orderBy("k").collect():  # one to k values, k = 5 except for tiny items
        found = _matches(docs, items.filter(F.col("k") == size), similarity, radius, size)
        out = found if out is None else out.union(found)
    if out is None:
        return docs.select("doc_id", text_hash().alias("_th"), F.lit(None).cast(benchmark.schema["item_id"].dataType).alias("item_id"),
                           F.lit(0).alias("start"), F.lit(0.0).alias("similarity")).filter("false")
    return out


def dense_windows(docs: DataFrame, lengths: DataFrame, similarity: float, k: int) -> DataFrame:
    """doc_id, _th, words, start: the windows of ``words`` words with enough shingles of items of that length
    (``lengths``: words, h). A window is found at the first such shingle in it."""
    flat = docs.select("doc_id", text_hash().alias("_th"), shingles(F.col("text"), k).alias("sh"))
    flat = flat.select("doc_id", "_th", F.size("sh").alias("size"), F.posexplode("sh").alias("p", "h"))
    places = flat.join(lengths, "h").groupBy("doc_id", "_th", "words").agg(
        F.max("size").alias("size"), F.array_sort(F.collect_set("p")).alias("at"))
    n_item = F.col("words") - (k - 1)
    n = F.least(n_item, F.col("size"))
    places = places.select("doc_id", "_th", "words", "at", n.alias("n"), (F.col("size") - n).alias("last"),
                           F.ceil(similarity * (n + n_item) / (1 + similarity) - 1e-9).cast("int").alias("need"))

    def starts(p, i):
        end = F.get("at", i + F.col("need") - 1)  # null: not enough of them are left
        low = F.greatest(F.coalesce(F.get("at", i - 1) + 1, F.lit(0)), end - F.col("n") + 1)
        high = F.least(p, F.col("last"))
        return F.when((low <= high) & end.isNotNull(), F.sequence(low, high)).otherwise(F.array().cast("array<int>"))

    found = places.filter(F.size("at") >= F.col("need")).select(
        "doc_id", "_th", "words", F.explode(F.flatten(F.transform("at", starts))).alias("start"))
    return found


def _matches(docs: DataFrame, items: DataFrame, similarity: float, radius: int, k: int) -> DataFrame:
    repeats = F.size("sh") > F.size(F.array_distinct("sh"))
    items = stored(items.select("item_id", "words", shingles(F.col("text"), k).alias("sh")).withColumn("again", repeats), "item-shingles")
    lengths = counted_broadcast(stored(items.select("words", F.explode("sh").alias("h")).distinct(), "item-lengths"))
    windows = stored(dense_windows(docs, lengths, similarity, k), "windows")
    # the documents concerned, once more, with their shingles
    hit = keyed_join(packed(docs.select("doc_id", "text")), stored(windows.select("doc_id", "_th").distinct(), "concerned"), "left_semi", small=True)
    hit = stored(hit.dropDuplicates(["doc_id", "_th"]).select(
        F.col("doc_id").alias("d_id"), F.col("_th").alias("d_th"), shingles(F.col("_doc.text"), k).alias("sh")), "concerned-shingles")
    window = ["doc_id", "_th", "words", "start"]
    sliced = windows.join(hit, F.col("doc_id").eqNullSafe(F.col("d_id")) & (F.col("_th") == F.col("d_th"))).select(
        *window, F.expr(f"slice(sh, start + 1, words - {k - 1})").alias("sh"))
    sliced = stored(sliced.withColumn("again", repeats), "window-shingles")
    prints = simhash(sliced, window, "sh")
    near = index_pairs(prints, simhash(items, ["item_id", "words"], "sh"), radius).select(*window, "item_id")
    # repeated shingles on either side: pairs over the items' first shingles, of which a similar window has one
    first = F.slice(F.array_sort(tagged(F.col("sh"))), F.lit(1), F.size("sh") - F.ceil(similarity * F.size("sh") - 1e-9).cast("int") + 1)
    heads = counted_broadcast(stored(items.select("item_id", "words", F.col("again").alias("item_again"), F.explode(first).alias("e")), "item-heads"))
    some = counted_broadcast(stored(items.groupBy("words").agg(F.max("again").alias("any_again")), "repeating-lengths"))
    asked = sliced.join(some, "words").filter(F.col("again") | F.col("any_again"))
    over = (asked.select(*window, "again", F.explode(tagged(F.col("sh"))).alias("e")).join(heads, ["words", "e"])
            .filter(F.col("again") | F.col("item_again")).select(*window, "item_id"))
    near = near.union(over).distinct()
    # exact weighted similarity of the candidates
    w = sliced.select(*[F.col(c).alias(f"w_{c}") for c in window], "sh")
    item_sets = stored(items.select("item_id", F.size("sh").alias("n_item"), tagged(F.col("sh")).alias("item_sh")), "item-sets")
    item_sets = counted_broadcast(item_sets, size=F.col("n_item"))
    cand = near.join(w, F.col("doc_id").eqNullSafe(F.col("w_doc_id")) & (F.col("_th") == F.col("w__th"))
                     & (F.col("words") == F.col("w_words")) & (F.col("start") == F.col("w_start"))).join(item_sets, "item_id")
    common = cand.select("doc_id", "_th", "item_id", "start", F.size("sh").alias("n_win"), "n_item",
                         F.size(F.array_intersect(tagged(F.col("sh")), "item_sh")).alias("low"))
    sim = F.col("low") / (F.col("n_win") + F.col("n_item") - F.col("low"))
    good = common.select("doc_id", "_th", "item_id", "start", sim.alias("similarity")).filter(F.col("similarity") >= similarity)
    best = good.groupBy("doc_id", "_th", "item_id").agg(F.min(F.struct((-F.col("similarity")).alias("s"), F.col("start"))).alias("b"))
    return best.select("doc_id", "_th", "item_id", F.col("b.start").alias("start"), (-F.col("b.s")).alias("similarity"))


def decontaminate(docs: DataFrame, benchmark: DataFrame, similarity: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The documents without any match, all columns as they were."""
    leaks = stored(matches(docs, benchmark, similarity, radius).select("doc_id", "_th").distinct(), "leaks")
    return unpacked(keyed_join(packed(docs), leaks, "left_anti", small=True)).select(*docs.columns)
