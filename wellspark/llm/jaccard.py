"""Set-similarity join of documents on word shingles: banded tiles, bitmap bounds, exact check."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.llm.components import components
from wellspark.llm.shared import in_filter, mix, partitions, scratch, shared_table, text_bytes, twice_seen

WORDS = 5
PERCENT = 75
SAMPLE = 48  # smallest shingle hashes kept of each document
CHOSEN = 24  # of these, so many of each kind (rare, frequent) name tiles
FREQUENT = 64  # a shingle in so many different documents is frequent
MOST_FREQUENT = 1 << 20  # frequent shingles are 1 in so many sampled ones at least
NARROW, WIDE = 64, 4096  # shingles that end the lowest band of sizes and begin the highest
BITS = 4  # bitmap bits for each shingle at the upper end of a band
FIRST, BEST, ALL = ROUNDS = ("first", "best", "all")  # the pairs of a tile that are tried, see _pairs
BLOCK = 8192  # rows of a tile that meet in one task
FILTER_BITS = 1 << 25  # 4 MB
SALTS = 32  # tasks that share the nodes of a component when they get its smallest id
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_set(text: bytes, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles; A-Z are lower-cased first.

    A text of fewer words is one shingle, one without words has none.
    """
    tokens = text.lower().split()
    if not tokens:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, tokens), np.uint64, len(tokens))
    size = min(words, len(tokens))
    rows = len(tokens) - size + 1
    out = np.full(rows, size, np.uint64)
    for i in range(size):
        out = out * _STEP + h[i:i + rows]
    return np.unique(mix(out))


def set_id(shingles: np.ndarray) -> int:
    """A 64-bit name of a set, as a signed number."""
    return int(np.uint64(xxhash.xxh3_64_intdigest(shingles.tobytes())).astype(np.int64))


def band_of(size: int) -> int:
    """The upper end of the band of sizes: a power of two within fixed limits."""
    return min(WIDE, max(NARROW, 1 << (max(size, 1) - 1).bit_length()))


def bitmap(shingles: np.ndarray, bits: int) -> bytes:
    found = np.zeros(bits, bool)
    found[(shingles & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(found).tobytes()


def fold_bitmap(data: bytes) -> bytes:
    """The bitmap of half the width: both halves laid over each other."""
    a = np.frombuffer(data, np.uint8)
    return (a[:len(a) // 2] | a[len(a) // 2:]).tobytes()


def _fits(n: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 100 * np.minimum(n, m) >= PERCENT * np.maximum(n, m)


def most_common(n, m, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A bound of the overlap of sets of n and m shingles with bitmaps a and b (rows of uint64).

    A bit of a that b lacks stands for one shingle at least that only the first set has, so the
    overlap is at most n less their number, and at most m less the number the other way round.
    """
    only_a = np.bitwise_count(a & ~b).sum(axis=-1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(axis=-1, dtype=np.int64)
    return np.minimum(n - only_a, m - only_b)


def possible(n, m, overlap) -> np.ndarray:
    """Whether sets of n and m shingles with at most this overlap can be linked."""
    return 100 * overlap >= PERCENT * (n + m - overlap)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def profiles(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, key (of id and text), n_shingles, node, sample, bitmap (null for no words)."""
    kind = dict(docs.dtypes)["doc_id"]
    rows = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key"), "text")

    def run(batches):
        for batch in batches:
            sets = [shingle_set(t) for t in text_bytes(batch)]
            empty = pa.array([not len(s) for s in sets])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([set_id(s) if len(s) else None for s in sets], pa.int64()),
                 pa.array([s[:SAMPLE].view(np.int64) for s in sets], pa.list_(pa.int64())),
                 pa.array([bitmap(s, BITS * band_of(len(s))) if len(s) else None for s in sets], pa.binary())],
                ["doc_id", "key", "n_shingles", "node", "sample", "bitmap"]) if len(empty) else batch

    return rows.mapInArrow(run, f"doc_id {kind}, key long, n_shingles long, node long, "
                                "sample array<long>, bitmap binary")


def _chosen(nodes: DataFrame) -> DataFrame:
    """``nodes`` with tokens in place of the sample: the shingle hashes that name their tiles.

    These are the smallest hashes of a set, frequent shingles apart from the rest: the 24 smallest
    rare ones, and the 24 smallest frequent ones of sets with many. Of two linked sets one part at
    least has a similarity of 0.6, and a random order of it starts with 24 shingles that only one
    set has with a chance below 0.4 ** 24; sets of up to 24 shingles show them all.
    """
    spark = nodes.sparkSession
    total = nodes.select(F.sum(F.size("sample")).alias("n")).first()["n"] or 0
    least = max(FREQUENT, -(-total // MOST_FREQUENT))
    # At most MOST_FREQUENT shingles can be that frequent, so the list has a fixed bound.
    often = nodes.select(F.explode("sample").alias("token")).groupBy("token").agg(F.count("*").alias("n"))
    frequent = spark.sparkContext.broadcast(
        np.sort(often.filter(F.col("n") >= least).select("token").toArrow().column(0).to_numpy()))

    def choose(batches):
        known = frequent.value
        for batch in batches:
            tokens = []
            for sample in batch.column("sample"):
                s = np.asarray(sample.values)
                where = np.searchsorted(known, s)
                hot = known[np.minimum(where, len(known) - 1)] == s if len(known) else np.zeros(len(s), bool)
                many = 8 * hot.sum() > 3 * len(s)
                tokens.append(np.concatenate([s[~hot][:CHOSEN], s[hot][:CHOSEN] if many else s[:0]]))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("node", "key", "n", "bitmap")), pa.array(tokens, pa.list_(pa.int64()))],
                                             ["node", "key", "n", "bitmap", "tokens"])

    return nodes.mapInArrow(choose, "node long, key long, n long, bitmap binary, tokens array<long>")


def _tiles(sets: DataFrame) -> DataFrame:
    """Rows (token, band, node, n, home): the tiles of two sets or more.

    A set is at home in the tiles of its band of sizes and a guest in those of the band below if
    linked sets may be there, so linked sets meet where the smaller one is at home or both are.
    """
    band = F.least(F.lit(WIDE), F.greatest(F.lit(NARROW), F.pow(F.lit(2.0), F.ceil(F.log2(F.col("n"))))).cast("int"))
    visits = (F.col("band") > NARROW) & (F.col("n") * PERCENT <= F.col("band") / 2 * 100)
    homes = F.explode(F.when(visits, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))).alias("home")
    own = F.when(F.col("home"), F.col("band")).otherwise((F.col("band") / 2).cast("int")).alias("band")
    rows = (sets.select("node", "n", "tokens", band.alias("band")).select("node", "n", "tokens", "band", homes)
            .select(F.explode("tokens").alias("token"), own, "node", "n", "home"))
    shared = rows.groupBy("token", "band").agg(F.count("*").alias("rows"), F.count_if("home").alias("homes")).filter("rows > 1 AND homes > 0")
    return rows.join(shared.select("token", "band"), ["token", "band"], "left_semi")


def _bitmaps(column, folded: np.ndarray, bits: int) -> np.ndarray:
    """Bitmaps as rows of uint64, those of guests folded to the width of the tile."""
    data = column.to_pylist()
    raw = b"".join(fold_bitmap(x) if f else x for x, f in zip(data, folded))
    return np.frombuffer(raw, np.uint64).reshape(len(data), bits // 64)


def _pairs(tiles: DataFrame, labels: DataFrame | None, sets: DataFrame, which: str) -> DataFrame:
    """Pairs (a, b) within tiles whose sets may be linked and aren't in one component yet.

    Sets are held against the bitmap bound inside the task; only pairs that pass leave it. These
    are, by ``which``, a tile's first set and the others; every set and its most promising partner
    among those of components that have more sets in the tile; or all, each pair in the tile of
    its smallest common token alone.
    A tile of more than BLOCK rows is cut into blocks by the hash of the node, and each two blocks
    meet in a task of their own.
    """
    named = tiles.withColumn("component", F.col("node"))
    if labels is not None:
        named = tiles.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (named.groupBy("token", "band").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("rows"))
             .filter("lo <> hi").select("token", "band", F.ceil(F.col("rows") / BLOCK).cast("int").alias("blocks")))
    mine = F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)) if which != FIRST else F.col("block")
    rows = (named.join(mixed, ["token", "band"]).withColumn("block", mine).withColumn("other", other)
            .withColumn("first", F.least("block", "other")).withColumn("second", F.greatest("block", "other"))
            .join(sets.select("node", "bitmap", *(["tokens"] if which == ALL else [])), "node"))
    by = ["token", "band", "first", "second"]
    dealt = (rows.select(*by, "block", "node", "n", "home", "component", "bitmap", *(["tokens"] if which == ALL else []))
             .repartition(partitions(tiles.sparkSession), *by).sortWithinPartitions(*by))

    def pairs_of(t: pa.Table):
        token, bits = t.column("token")[0].as_py(), BITS * t.column("band")[0].as_py()
        across = t.column("first")[0].as_py() != t.column("second")[0].as_py()
        node, n, comp, block = (t.column(c).to_numpy() for c in ("node", "n", "component", "block"))
        home = t.column("home").to_numpy(zero_copy_only=False)
        maps = _bitmaps(t.column("bitmap"), ~home, bits)
        if which == FIRST:
            first = int(node.argmin())
            tries = [(first, np.flatnonzero(node != node[first]))]
        else:
            tokens = t.column("tokens").to_pylist() if which == ALL else None
            _, label, size = np.unique(comp, return_inverse=True, return_counts=True)
            rank = np.empty(len(size), np.int64)
            rank[np.lexsort((np.arange(len(size)), size))] = np.arange(len(size))
            rank = rank[label]
            tries = ((i, np.flatnonzero(rank > rank[i])) for i in np.flatnonzero(rank < rank.max()))
        for i, j in tries:
            j = j[(home[j] | home[i]) & _fits(n[j], n[i]) & ((block[j] != block[i]) if across else True)]
            if not len(j):
                continue
            bound = most_common(n[i], n[j], maps[i], maps[j])
            good = possible(n[i], n[j], bound)
            j, bound = j[good], bound[good]
            if which == ALL and len(j):
                own = set(tokens[i])
                j = j[np.array([min(own.intersection(tokens[x])) == token for x in j], bool)]
            elif which == BEST and len(j):
                j = j[np.lexsort((node[j], -bound))[:1]]
            if len(j):
                yield np.minimum(node[i], node[j]), np.maximum(node[i], node[j])

    def run(batches):
        def flush(table):
            found = list(pairs_of(table))
            if found:
                a, b = (np.concatenate(x) for x in zip(*found))
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

        held = []
        for batch in batches:
            if not batch.num_rows:
                continue
            keys = np.stack([batch.column(k).to_numpy().astype(np.int64) for k in range(4)])
            ends = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            cuts = [0, *ends.tolist(), batch.num_rows]
            if held and [held[0].column(k)[0].as_py() for k in range(4)] != keys[:, 0].tolist():
                yield from flush(pa.Table.from_batches(held))
                held = []
            for lo, hi in zip(cuts, cuts[1:]):
                if lo:
                    yield from flush(pa.Table.from_batches(held))
                    held = []
                held.append(batch.slice(lo, hi - lo))
        if held:
            yield from flush(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, "a long, b long").distinct()


def _verified(pairs: DataFrame, docs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose sets reach the similarity, by exact intersection of the sorted sets."""
    spark = docs.sparkSession
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
    keys = wanted.join(sets.select("node", "key"), "node").select(F.col("key").alias("h"), F.lit(True).alias("twice"))
    known = spark.sparkContext.broadcast(twice_seen(keys, FILTER_BITS))

    def fetch(batches):
        for batch in batches:
            hit = in_filter(known.value, batch.column(0).to_numpy().view(np.uint64))
            sets = [shingle_set(t) for t in text_bytes(batch.filter(pa.array(hit)))]
            sets = [s for s in sets if len(s)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([set_id(s) for s in sets], pa.int64()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], ["node", "shingles"])

    whole = shared_table(docs.select(F.xxhash64("doc_id", "text").alias("key"), "text")
                         .mapInArrow(fetch, "node long, shingles binary")
                         .join(wanted, "node", "left_semi").dropDuplicates(["node"]))
    known.destroy()
    x, y = (whole.select(F.col("node").alias(c), F.col("shingles").alias(f"set_{c}")) for c in "ab")

    def check(batches):
        for batch in batches:
            good = [linked(np.frombuffer(p, np.uint64), np.frombuffer(q, np.uint64))
                    for p, q in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())]
            yield batch.select([0, 1]).filter(pa.array(good, pa.bool_()))

    return shared_table(pairs.join(x, "a").join(y, "b").select("a", "b", "set_a", "set_b")
                        .mapInArrow(check, "a long, b long"))


def _joined(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """Labels (node, component) after further links; nodes without a link may be absent.

    Only links between different components count any more, and each two components are one edge.
    """
    if labels is None:
        return components(links)
    a = labels.withColumnsRenamed({"node": "a", "component": "of_a"})
    b = labels.withColumnsRenamed({"node": "b", "component": "of_b"})
    between = shared_table(links.join(a, "a", "left").join(b, "b", "left").select(
        F.coalesce("of_a", "a").alias("a"), F.coalesce("of_b", "b").alias("b")).filter("a <> b").distinct())
    if between.isEmpty():
        return labels
    moved = components(between).select(F.col("node").alias("component"), F.col("component").alias("into"))
    known = labels.join(moved, "component", "left").select("node", F.coalesce("into", "component").alias("component"))
    # A node without label is a component by its own name.
    new = moved.join(labels, moved["component"] == labels["node"], "left_anti").select(
        F.col("component").alias("node"), F.col("into").alias("component"))
    return shared_table(known.unionByName(new))


def similar_documents(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, key, n_shingles, component, component_id.

    Documents link when 100 * intersection >= 75 * union of their sets of five-word shingles.
    component_id is the smallest doc_id that can be reached by links, itself included. Equal sets
    are one node, so copies cost one row. This is a search for components: a pair of sets that are
    known to be in one component is not tried any more, so links are not counted.

    Sets are compared as 64-bit hashes. Null and empty texts have no set and link with nothing;
    rows with equal ids are separate documents; ``key`` is the hash of id and text, ``component``
    a hash that names the component where ids are null. An empty table gives an empty result.
    """
    with scratch(docs.sparkSession):
        return shared_table(_similar_documents(docs), stays=True)


def _similar_documents(docs: DataFrame) -> DataFrame:
    rows = shared_table(profiles(docs))
    nodes = shared_table(rows.filter("n_shingles > 0").groupBy("node").agg(
        F.min("key").alias("key"), F.first("n_shingles").alias("n"),
        F.first("sample").alias("sample"), F.first("bitmap").alias("bitmap")))
    sets = shared_table(_chosen(nodes))
    tiles = shared_table(_tiles(sets))
    labels = tried = None
    for which in ROUNDS:
        pairs = _pairs(tiles, labels, sets, which)
        if tried is not None:
            pairs = pairs.join(tried, ["a", "b"], "left_anti")
        pairs = shared_table(pairs)
        if which != FIRST and pairs.isEmpty():
            continue
        good = _verified(pairs, docs, sets)
        tried = pairs if tried is None else tried.unionByName(pairs)
        labels = _joined(labels, good)
    ids = rows.filter("n_shingles > 0").groupBy("node").agg(F.min("doc_id").alias("least"))
    named = shared_table(ids.join(labels, "node", "left"))
    # A component can hold a third of all nodes: its smallest id is summed up where the nodes are
    # and goes back to them in SALTS copies. A node without links needs neither.
    linked = named.filter("component IS NOT NULL").withColumn("salt", F.pmod(F.xxhash64("node"), F.lit(SALTS)).cast("int"))
    whole = linked.groupBy("component").agg(F.min("least").alias("component_id")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    known = linked.join(whole, ["component", "salt"]).select("node", "component", "component_id").unionByName(
        named.filter("component IS NULL").select("node", F.col("node").alias("component"), F.col("least").alias("component_id")))
    # Empty sets get a name of their own, so that they do not meet in one task.
    left = rows.select("doc_id", "key", "n_shingles", F.coalesce("node", "key").alias("at"), F.col("node").isNull().alias("empty"))
    return left.join(known, (left["at"] == known["node"]) & ~left["empty"], "left").select(
        "doc_id", "key", "n_shingles", F.coalesce("component", "key").alias("component"),
        F.when(F.col("empty"), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"))


def one_per_component(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each component: one with the smallest id; all its columns stay.

    Texts without words link with nothing and stay; rows of the same id and text count once.
    """
    found = similar_documents(docs.select("doc_id", "text"))
    best = (found.filter(F.col("doc_id").eqNullSafe(F.col("component_id")))
            .groupBy("component").agg(F.min("key").alias("_llm_key")).select("_llm_key"))
    return (docs.withColumn("_llm_key", F.xxhash64("doc_id", "text")).join(best, "_llm_key", "left_semi")
            .dropDuplicates(["_llm_key"]).drop("_llm_key"))
