"""Benchmark passages in documents: SimHash windows, Hamming blocks, exact check. DataFrame functions only."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wellspark.llm.shared import scratch, shared_table

WORDS = 5
SIMILARITY = 0.75
BLOCKS, BLOCK_BITS = 8, 8
BLOCK_RADIUS = 2
# With distance RADIUS or less, one of the blocks has at most BLOCK_RADIUS of the differing bits.
RADIUS = BLOCKS * (BLOCK_RADIUS + 1) - 1
STRETCH = 64  # starts side by side whose windows are fingerprinted in one go, or an item's length
SLICE_ITEMS, SLICE_SHINGLES = 500, 20_000  # of the benchmark that one pass over the documents takes
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BLANK = " \t\n\x0b\x0c\r"


def word_array(text: Column) -> Column:
    """The words of a text, A-Z in lower case; none of a null text."""
    plain = F.btrim(F.translate(F.coalesce(text, F.lit("")), _UPPER, _LOWER), F.lit(_BLANK))
    return F.when(plain == "", F.array().cast("array<string>")).otherwise(F.split(plain, r"[\x20\x09-\x0D]+"))


def shingle_array(words: Column, size: int) -> Column:
    """Hashes of each ``size`` words in a row, as many as there are places for them."""
    places = F.size(words) - (size - 1)
    return F.when(places < 1, F.array().cast("array<bigint>")).otherwise(
        F.transform(F.sequence(F.lit(1), F.greatest(places, F.lit(1))), lambda i: F.xxhash64(F.slice(words, i, size))))


def simhash(shingles: Column) -> Column:
    """64 bits: each is 1 where more than half of the shingles, repeats included, have a 1."""
    half = F.size(shingles)

    def bit(number: Column, b: Column) -> Column:
        ones = F.aggregate(shingles, F.lit(0), lambda n, h: n + F.call_function("getbit", h, b).cast("int"))
        return F.when(2 * ones > half, number.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), b))).otherwise(number)

    return F.aggregate(F.sequence(F.lit(0), F.lit(63)), F.lit(0).cast("bigint"), bit)


def _block(fingerprint: Column, b: Column) -> Column:
    return F.call_function("shiftright", fingerprint, b * BLOCK_BITS).bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("bigint"))


def _near_masks() -> list[int]:
    return [sum(1 << i for i in c) for k in range(BLOCK_RADIUS + 1) for c in combinations(range(BLOCK_BITS), k)]


def rolling_simhash(shingles: Column, span: Column, longest: int) -> Column:
    """``simhash`` of each ``span`` shingles in a row, in order; of all of them where there are fewer.

    ``longest`` is the largest span. The 64 bit counts are fields of whole numbers: one shingle
    comes in, one goes out.
    """
    width = 16 if longest < 1 << 14 else 32
    ones = F.lit(sum(1 << i for i in range(0, 64, width)))
    top = width - 2
    n = F.least(span, F.size(shingles))
    counts = [f"c{k}" for k in range(width)]

    def field(h: Column, k: int) -> Column:
        return F.shiftright(h, k).bitwiseAND(ones)

    def majority(s: Column) -> Column:
        out = F.lit(0).cast("bigint")
        for k, c in enumerate(counts):
            # The fill lifts a count of more than half of n to the field's last bit but one.
            more = (s[c] + s["fill"]).bitwiseAND(ones * F.lit(1 << top))
            out = out.bitwiseOR(F.shiftright(more, top - k) if k <= top else F.shiftleft(more, k - top))
        return out

    def step(s: Column, x: Column) -> Column:
        sums = [(s[c] + field(x["new"], k) - field(x["old"], k)).alias(c) for k, c in enumerate(counts)]
        prints = F.when(x["full"], F.concat(s["prints"], F.array(majority(s)))).otherwise(s["prints"])
        return F.struct(*sums, s["fill"].alias("fill"), prints.alias("prints"))

    moves = F.transform(shingles, lambda h, i: F.struct(
        h.alias("new"), F.when(i >= n, F.get(shingles, i - n)).otherwise(F.lit(0).cast("bigint")).alias("old"), (i >= n).alias("full")))
    fill = ((F.lit((1 << top) - 1) - F.floor(n / 2)).cast("bigint") * ones).alias("fill")
    begin = F.struct(*[F.lit(0).cast("bigint").alias(c) for c in counts], fill, F.array().cast("array<bigint>").alias("prints"))
    return F.aggregate(moves, begin, step, lambda s: F.concat(s["prints"], F.array(majority(s))))


def _slices(items: DataFrame) -> list[tuple[int, int, list[int]]]:
    """(shingle size, words of the longest item, item numbers) of each pass; only numbers and sizes reach the driver."""
    sizes = items.select("number", F.size("words").alias("n")).orderBy("number").toArrow()
    by_size: dict[int, list[list[tuple[int, int]]]] = {}
    room: dict[int, int] = {}
    for number, n in zip(sizes.column(0).to_pylist(), sizes.column(1).to_pylist()):
        size = min(n, WORDS)
        parts = by_size.setdefault(size, [])
        need = n - size + 1
        if not parts or len(parts[-1]) >= SLICE_ITEMS or room[size] < need:
            parts.append([])
            room[size] = SLICE_SHINGLES
        parts[-1].append((n, number))
        room[size] -= need
    return [(size, max(part)[0], [number for _, number in part]) for size, parts in sorted(by_size.items()) for part in parts]


def _pass(docs: DataFrame, items: DataFrame, size: int, longest: int) -> DataFrame:
    """Rows (key, number, start, similarity, lined) of the windows that are like an item of one slice."""
    items = shared_table(items.withColumn("shingles", shingle_array(F.col("words"), size)).select(
        "number", F.size("words").alias("m"), "shingles"))
    anchors = items.select("m", F.posexplode("shingles").alias("q", "shingle")).distinct()
    known = sorted(set(anchors.select("shingle").toArrow().column(0).to_pylist()))
    # A window without a shingle of an item has similarity 0; only texts with one go on.
    grams = docs.select("doc_id", "key", shingle_array(F.col("words"), size).alias("shingles"))
    hits = F.filter(F.col("shingles"), lambda h: h.isin(known))
    # As a generator and not as a filter, the test reads the shingles and does not compute them again.
    row = F.array(F.struct("doc_id", "key", "shingles"))
    found = shared_table(grams.select(F.explode(F.when(F.size(hits) > 0, row)).alias("x")).select("x.*")
                         .dropDuplicates(["key"]))
    places = (found.select("key", F.size("shingles").alias("places"), F.posexplode("shingles").alias("p", "shingle"))
              .filter(F.col("shingle").isin(known)))
    # Every window that holds a shingle of an item of its size, in stretches of starts side by side.
    span = F.col("m") - (size - 1)
    length = F.greatest(F.lit(STRETCH), span)
    first = F.greatest(F.lit(0), F.col("p") - span + 1)
    end = F.greatest(F.lit(0), F.col("places") - span)
    # The window that puts the shingle where the item has it, moved into the text where it sticks out.
    lined = F.greatest(F.lit(0), F.least(F.col("p") - F.col("q"), F.col("places") - span))
    placed = shared_table(places.join(F.broadcast(anchors), "shingle").select(
        "key", "m", first.alias("first"), F.least("p", end).alias("last"), lined.alias("start")))
    touched = placed.select("key", "m", "first", "last").distinct()
    touched = touched.withColumn("stretch", F.explode(F.sequence(
        F.floor(F.col("first") / length).cast("int"), F.floor(F.col("last") / length).cast("int"))))
    stretches = touched.groupBy("key", "m", "stretch").agg(
        F.min(F.greatest(F.col("first"), F.col("stretch") * length)).alias("first"),
        F.max(F.least(F.col("last"), (F.col("stretch") + 1) * length - 1)).alias("last"))
    stretches = shared_table(stretches.join(found.select("key", "shingles"), "key").select(
        "key", "m", "first", F.slice("shingles", F.col("first") + 1, F.col("last") - F.col("first") + span).alias("shingles")))
    windows = (stretches.withColumn("prints", rolling_simhash(F.col("shingles"), span, longest))
               .select("key", "m", "first", "shingles", F.posexplode("prints").alias("i", "fingerprint")))
    blocks = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1)))
    prints = items.select("number", "m", simhash(F.col("shingles")).alias("item_print"), blocks.alias("block"))
    masks = F.explode(F.array(*[F.lit(x).cast("bigint") for x in _near_masks()]))
    near = prints.withColumn("mask", masks).select(
        "number", "m", "item_print", "block", _block(F.col("item_print"), F.col("block")).bitwiseXOR(F.col("mask")).alias("value"))
    # A slice has at most SLICE_ITEMS items, so this index has a fixed largest size.
    ours = windows.withColumn("block", blocks).withColumn("value", _block(F.col("fingerprint"), F.col("block")))
    # Every pair is taken once, through the first of its blocks that is near.
    apart = F.col("fingerprint").bitwiseXOR(F.col("item_print"))
    way = F.coalesce(*[F.when(F.bit_count(_block(apart, F.lit(b))) <= BLOCK_RADIUS, b) for b in range(BLOCKS)])
    pairs = ours.join(F.broadcast(near), ["m", "block", "value"]).filter((F.bit_count(apart) <= RADIUS) & (F.col("block") == way))
    # Shingles weigh as often as they occur: the sum of the smaller counts over that of the larger.
    theirs = F.col("theirs")
    weights = items.select("number", F.col("shingles").alias("theirs"), F.array_distinct(F.filter(
        "shingles", lambda h, i: F.array_position("shingles", h) <= i)).alias("again"))
    pairs = (pairs.select("key", "m", "number", (F.col("first") + F.col("i")).alias("start"), F.slice("shingles", F.col("i") + 1, span).alias("window"))
             .join(F.broadcast(weights), "number"))

    def times(where: Column, h: Column) -> Column:
        return F.size(F.filter(where, lambda x: x == h))

    more = F.aggregate(F.array_intersect("window", "again"), F.lit(0), lambda n, h: n + F.least(
        times(F.col("window"), h), times(theirs, h)) - 1)
    common = F.size(F.array_intersect("window", "theirs")) + F.when(F.size("again") > 0, more).otherwise(0)
    both = pairs.select("key", "m", "number", "start", (F.size("window") + F.size(theirs)).alias("n"), common.alias("common"))
    alike = both.withColumn("similarity", F.col("common") / (F.col("n") - F.col("common"))).filter(F.col("similarity") >= SIMILARITY)
    lines = placed.select("key", "m", "start", F.lit(True).alias("lined")).distinct()
    return alike.join(lines, ["key", "m", "start"], "left").select(
        "key", "number", "start", "similarity", F.coalesce("lined", F.lit(False)).alias("lined"))


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Which items of ``benchmark`` (item_id, text) are in which of ``docs`` (doc_id, text).

    Rows (doc_id, key, item_id, similarity, start): the best item-sized window of words of the
    document; ``key`` is the hash of id and text. Of equally good windows it is the first that lines
    up a shingle with its place in an item of its size, else the first. Every window that
    holds a shingle of five words of an item of its size is fingerprinted; those whose SimHash is
    within 23 of 64 bits of an item of the same size are found through blocks of 8 bits and compared
    exactly by weighted shingles; 0.75 or more counts. Items of fewer than five words have shingles of their
    size. Null and wordless texts hold nothing, and nothing holds them; repeated rows give one
    result; items with equal ids are told apart by their texts, and the best of them is reported.
    """
    with scratch(docs.sparkSession):
        return shared_table(_contaminated(docs, benchmark), stays=True)


def _contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    spark = docs.sparkSession
    items = (benchmark.select("item_id", word_array(F.col("text")).alias("words")).filter(F.size("words") > 0).distinct()
             .withColumn("number", F.xxhash64("item_id", "words")))
    items = shared_table(items)
    texts = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), word_array(F.col("text")).alias("words"))
    parts = [_pass(texts, items.filter(F.col("number").isin(numbers)), size, longest) for size, longest, numbers in _slices(items)]
    kinds = dict(docs.dtypes)["doc_id"], dict(benchmark.dtypes)["item_id"]
    if not parts:
        return spark.createDataFrame([], f"doc_id {kinds[0]}, key long, item_id {kinds[1]}, similarity double, start int")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    best = (found.join(items.select("number", "item_id"), "number").groupBy("key", "item_id")
            .agg(F.max(F.struct("similarity", "lined", (-F.col("start")).alias("place"))).alias("best")))
    ids = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"))
    return ids.join(best, "key").select(
        "doc_id", "key", "item_id", F.col("best.similarity").alias("similarity"), (-F.col("best.place")).alias("start")).distinct()


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without the documents that hold an item of ``benchmark``; all columns stay."""
    keys = contaminated(docs.select("doc_id", "text"), benchmark).select(F.col("key").alias("_llm_key")).distinct()
    return docs.join(keys, F.xxhash64(docs["doc_id"], docs["text"]) == keys["_llm_key"], "left_anti")
