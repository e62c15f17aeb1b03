"""Personal data: base patterns, and contexts bootstrapped from what they find. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspark.llm.shared import scratch, shared_table

KINDS = ("email", "ip", "card", "phone")
CANDIDATE = len(KINDS)
# Possessive loops and the look-behinds change no match; they keep long runs linear.
_PATTERNS = (
    r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?+[0-9])++",
    r"\+[0-9][\x20().0-9-]+[0-9]",
    r"(?<![A-Za-z0-9_-])(?=[A-Za-z_-]*+[0-9])[A-Za-z0-9_-]{6,}+",
)
_NEEDS = ("@", ".", None, "+", None)  # a text without it has no match
_DIGIT = r"[0-9]"
CONTEXT = 64  # characters before a mention in which its two left words must be
LEAST_SEEDS = 5  # different base finds that a pattern needs
CONFIDENCE = 0.8  # of a pattern and of a discovery
ROUNDS = 3  # of scoring in a generation
GENERATIONS = 6  # of seeds at most; one that adds none is the last
BITS = 1 << 20  # of the bitmap of patterns


def _mentions(text: Column, kind: int) -> Column:
    """Array of (kind, i, before, tail, found): matches and the text between them, the last without match."""
    pattern = F.lit(_PATTERNS[kind])
    pairs = F.zip_with(F.split(text, _PATTERNS[kind], -1), F.regexp_extract_all(text, pattern, F.lit(0)),
                       lambda p, m: F.struct(F.length(p).alias("before"), F.right(p, F.lit(CONTEXT)).alias("tail"), m.alias("found")))
    rows = F.transform(pairs, lambda x, i: F.struct(
        F.lit(kind).alias("kind"), i.alias("i"), x["before"].alias("before"), x["tail"].alias("tail"), x["found"].alias("found")))
    test = F.contains(text, F.lit(_NEEDS[kind])) if _NEEDS[kind] else F.lit(True)
    if _NEEDS[kind] != "@":
        test = test & text.rlike(_DIGIT)
    return F.when(test, rows)


def _luhn(digits: Column) -> Column:
    """Whether the check digit is right: from the right, every second digit doubled, its digits added."""
    def add(s: Column, i: Column) -> Column:
        d = F.substring(s["digits"], F.length(s["digits"]) - i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return F.struct((s["sum"] + F.when(i % 2 == 1, twice).otherwise(d)).alias("sum"), s["digits"].alias("digits"))

    # The digits travel with the sum, so that they are taken out of the text once.
    start = F.struct(F.lit(0).alias("sum"), digits.alias("digits"))
    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), start, add, lambda s: s["sum"] % 10 == 0)


def _valid(kind: Column, found: Column) -> Column:
    digits = F.regexp_replace(found, "[^0-9]", "")
    n = F.length(digits)
    small = F.forall(F.split(found, r"\."), lambda part: (F.length(F.ltrim(part, F.lit("0"))) <= 3)
                     & (F.right(F.concat(F.lit("000"), part), F.lit(3)).cast("int") <= 255))
    return (F.when(kind == 0, True).when(kind == 1, small)
            .when(kind == 2, F.when(n.between(14, 19), _luhn(digits)).otherwise(False))
            .when(kind == 3, n.between(10, 15)).otherwise(n >= 4))


def find_mentions(docs: DataFrame) -> DataFrame:
    """Rows (key, kind, start, end, found, left, copies): valid base finds and identifier-like candidates.

    ``key`` is the hash of doc_id and text, start and end count code points, left is the two words
    before, in lower case (null where there are fewer), copies the number of equal rows. Candidates have six characters or more,
    four digits or more, and touch no base find.
    """
    text = F.coalesce("text", F.lit(""))
    parts = F.flatten(F.array_compact(F.array(*[_mentions(text, k) for k in range(len(_PATTERNS))])))
    rows = (docs.select(F.xxhash64("doc_id", "text").alias("key"), F.explode(parts).alias("x"))
            .select("key", "x.*").filter("found IS NOT NULL"))
    # Repeated rows have equal keys and finds; one shuffle serves this step and the window.
    rows = rows.repartition("key").groupBy("key", "kind", "i").agg(*[F.first(c).alias(c) for c in ("before", "tail", "found")], F.count("*").alias("copies"))
    so_far = F.sum(F.col("before") + F.length("found")).over(Window.partitionBy("key", "kind").orderBy("i"))
    rows = rows.withColumn("end", so_far.cast("int")).withColumn("start", F.col("end") - F.length("found"))
    words = F.split(F.btrim(F.lower("tail"), F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")
    whole = F.when(F.length("tail") < CONTEXT, 2).otherwise(3)
    left = F.when(F.size(words) >= whole, F.array_join(F.slice(words, -2, 2), " "))
    rows = rows.filter(_valid(F.col("kind"), F.col("found"))).select("key", "kind", "start", "end", "found", left.alias("left"), "copies")
    # Finds of one text, in order: a candidate touches a base find if one before it ends late or
    # one after it starts early.
    place = Window.partitionBy("key").orderBy("start", "kind")
    base_end = F.when(F.col("kind") < CANDIDATE, F.col("end"))
    base_start = F.when(F.col("kind") < CANDIDATE, F.col("start"))
    before = F.max(base_end).over(place.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(base_start).over(place.rowsBetween(1, Window.unboundedFollowing))
    touched = (F.coalesce(before, F.lit(-1)) > F.col("start")) | (F.coalesce(after, F.col("end")) < F.col("end"))
    return rows.withColumn("touched", touched).filter((F.col("kind") < CANDIDATE) | ~F.col("touched")).drop("touched")


def _bitmap(patterns: DataFrame) -> DataFrame:
    """One row: the bits of the patterns' hashes modulo BITS, as bytes. Of one size for any number of patterns."""
    spark = patterns.sparkSession
    bit = patterns.select(F.pmod("pattern", F.lit(BITS)).alias("bit"))
    cells = bit.groupBy(F.shiftright("bit", 3).alias("id")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1), F.pmod("bit", F.lit(8)).cast("int"))).alias("v"))
    places = spark.range(BITS // 8).join(cells, "id", "left").select(F.struct("id", F.coalesce("v", F.lit(0)).alias("v")).alias("x"))
    digits = F.transform(F.array_sort(F.collect_list("x")), lambda x: F.lpad(F.hex(x["v"]), 2, "0"))
    return places.agg(F.unhex(F.array_join(digits, "")).alias("bits"))


def _uses(docs: DataFrame, patterns: DataFrame) -> DataFrame:
    """How often the two words of each pattern (a hash) are followed by a word, in all texts.

    A bitmap of the patterns lets most other pairs of words fall out where they are read; what is
    left is counted there and meets the patterns as a sum.
    """
    words = F.split(F.btrim(F.lower(F.coalesce("text", F.lit(""))), F.lit(" \t\n\x0b\x0c\r")), r"[\x20\x09-\x0D]+")
    texts = docs.select(words.alias("words")).filter(F.size("words") > 2)
    pairs = texts.select(F.explode(F.transform(F.sequence(F.lit(1), F.size("words") - 2), lambda i: F.xxhash64(
        F.concat_ws(" ", F.element_at("words", i), F.element_at("words", i + 1))))).alias("pattern"))
    bit, bits = F.pmod("pattern", F.lit(BITS)), shared_table(_bitmap(patterns)).select("bits").scalar()
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(bit, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = byte.bitwiseAND(F.call_function("shiftleft", F.lit(1), F.pmod(bit, F.lit(8)).cast("int"))) != 0
    return pairs.filter(marked).groupBy("pattern").agg(F.count("*").alias("uses")).join(patterns, "pattern")


def discover(docs: DataFrame, mentions: DataFrame) -> DataFrame:
    """Candidates that trusted contexts give away: key, start, end, kind (that of the seeds).

    The two words before a mention are its pattern, base finds are the first seeds. A generation
    induces patterns from all seeds, scores patterns and instances in turn, and makes instances of
    a score of CONFIDENCE seeds of the next one; it is the last when none is new, or after
    GENERATIONS.

    A pattern is induced if LEAST_SEEDS different seeds stand after it and most of its seeds'
    occurrences are of one kind. ROUNDS times, its confidence is the sum of its instances' scores,
    each as often as it occurs there in all rows, over all its uses in all rows, and an instance's
    score is one minus the product of what its patterns of confidence leave open (a base find's is
    1; a seed keeps the best it had). Only patterns of a confidence of CONFIDENCE count, and only
    they mark, in the last generation, the seeds of their kind that stand after them.
    """
    spark = docs.sparkSession
    edges = shared_table(mentions.filter("left IS NOT NULL").select(
        F.xxhash64("left").alias("pattern"), F.xxhash64("found").alias("instance"), F.col("kind").alias("own"), "copies")
                         .groupBy("pattern", "instance", "own").agg(F.sum("copies").alias("times")))
    none = spark.createDataFrame([], "key long, start int, end int, kind int")
    base = F.col("own") < CANDIDATE
    fits = (F.col("own") == F.col("kind")) | ~base
    scores = shared_table(edges.filter(base).select("instance", F.col("own").alias("kind"), F.lit(1.0).alias("score")).distinct())
    seeds, uses, trusted = scores.count(), spark.createDataFrame([], "pattern long, uses long"), None
    for _ in range(GENERATIONS):
        support = (edges.join(scores.filter(F.col("score") >= CONFIDENCE), "instance").filter(fits)
                   .groupBy("pattern", "kind").agg(F.sum("times").alias("times"), F.count_distinct("instance").alias("n")))
        induced = shared_table(support.groupBy("pattern").agg(
            F.max(F.struct("times", "n", (-F.col("kind")).alias("order"))).alias("best"), F.sum("times").alias("seeds"))
            .filter((F.col("best.n") >= LEAST_SEEDS) & (F.col("best.times") >= CONFIDENCE * F.col("seeds")))
            .select("pattern", (-F.col("best.order")).alias("kind")))
        new = shared_table(induced.select("pattern").join(uses, "pattern", "left_anti"))
        if not new.isEmpty():
            uses = shared_table(uses.unionByName(_uses(docs, new)))
        part = shared_table(edges.join(induced, "pattern").filter(fits).join(uses, "pattern"))
        for _ in range(ROUNDS):
            trusted = shared_table(part.join(scores, ["instance", "kind"]).groupBy("pattern", "kind", "uses")
                                   .agg(F.sum(F.col("score") * F.col("times")).alias("sum"))
                                   .withColumn("confidence", F.least(F.lit(1.0), F.col("sum") / F.col("uses")))
                                   .filter(F.col("confidence") >= CONFIDENCE).select("pattern", "kind", "confidence"))
            if trusted.isEmpty():
                return none
            reached = part.join(trusted, ["pattern", "kind"]).groupBy("instance", "kind").agg(
                (1 - F.product(1 - F.col("confidence"))).alias("score"))
            scores = shared_table(scores.unionByName(reached).groupBy("instance", "kind").agg(F.max("score").alias("score")))
        now = scores.filter(F.col("score") >= CONFIDENCE).count()
        if now == seeds:
            break
        seeds = now
    good = (scores.filter(F.col("score") >= CONFIDENCE).groupBy("instance")
            .agg(F.max(F.struct("score", (-F.col("kind")).alias("order"))).alias("best"))
            .select("instance", (-F.col("best.order")).alias("as_kind")))
    cued = trusted.select("pattern", F.col("kind").alias("as_kind"))
    return (mentions.filter((F.col("kind") == CANDIDATE) & F.col("left").isNotNull())
            .withColumn("instance", F.xxhash64("found")).withColumn("pattern", F.xxhash64("left"))
            .join(cued, "pattern").join(good, ["instance", "as_kind"])
            .select("key", "start", "end", F.col("as_kind").alias("kind")))


def _joined(spans: Column) -> Column:
    """kind:start:end of (start, kind, end), in this order, joined by commas."""
    name = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(
        ":", F.element_at(name, s["kind"] + 1), s["start"], s["end"])), ",")


def personal_data(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, key, a count of each kind, base, spans, n_added.

    ``base`` lists the finds of the four patterns as kind:start:end, ``spans`` these and the
    discoveries; both are empty texts where there are none, so for null and empty texts too.
    Starts and ends count code points. Repeated rows have equal results; an empty table gives an
    empty result.
    """
    with scratch(docs.sparkSession):
        return shared_table(_personal_data(docs), stays=True)


def _personal_data(docs: DataFrame) -> DataFrame:
    mentions = shared_table(find_mentions(docs.select("doc_id", "text")))
    added = discover(docs.select("doc_id", "text"), mentions).withColumn("added", F.lit(True))
    spans = mentions.filter(F.col("kind") < CANDIDATE).select("key", "start", "end", "kind", F.lit(False).alias("added"))
    span = F.struct("start", "kind", "end")
    counts = [F.count_if((F.col("kind") == k) & ~F.col("added")).alias(f"n_{name}") for k, name in enumerate(KINDS)]
    per_text = spans.unionByName(added).groupBy("key").agg(
        *counts, F.count_if("added").alias("n_added"),
        _joined(F.collect_list(F.when(~F.col("added"), span))).alias("base"), _joined(F.collect_list(span)).alias("spans"))
    zero = {c: F.lit(0).cast("long") for c in (*(f"n_{k}" for k in KINDS), "n_added")}
    empty = zero | {c: F.lit("") for c in ("base", "spans")}
    return docs.select("doc_id", F.xxhash64("doc_id", "text").alias("key")).join(per_text, "key", "left").select(
        "doc_id", "key", *[F.coalesce(c, x).alias(c) for c, x in empty.items()])
