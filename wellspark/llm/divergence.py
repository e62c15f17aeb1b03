"""How sources of a language differ in their words: exact divergences of term shares, by count cells."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wellspark.llm.shared import scratch, shared_table, text_bytes

MIN_DOCUMENTS = 3
LIMIT = 200  # ranks of the report of terms
SCALE = 1_000_000_000
SALTS = 32
PIECE = 1 << 20  # bytes of a text that are cut into words at a time
MOST_HELD = 300_000  # words that a task counts before it sends them on

# Letters A-Z go to a-z, other ASCII but a-z to a blank; a term is what lies between blanks.
_FOLDED = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


def _pieces(text: bytes):
    """The terms of a text, for a bounded number of bytes at a time."""
    text = text.translate(_FOLDED)
    start = 0
    while start < len(text):
        end = text.find(b" ", start + PIECE)
        end = len(text) if end < 0 else end
        yield text[start:end].split()
        start = end


def _counted(batches):
    """Counts of a task: occurrences and documents per language, source and term."""
    held: dict[tuple, tuple[Counter, Counter]] = {}

    def sent():
        for (lang, source), (n, documents) in held.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(n), pa.string()), pa.array([source] * len(n), pa.string()),
                 pa.array(list(n), pa.binary()).cast(pa.string()), pa.array(list(n.values()), pa.int64()),
                 pa.array([documents[t] for t in n], pa.int64())], ["lang", "source", "term", "n", "documents"])
        held.clear()

    fresh = 0
    for batch in batches:
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), text_bytes(batch)):
            n, documents = held.setdefault((lang, source), (Counter(), Counter()))
            distinct: set[bytes] = set()
            for words in _pieces(text):
                n.update(words)
                distinct.update(words)
            documents.update(distinct)
            fresh += len(distinct)
            if fresh > MOST_HELD:  # at most so many are new; count what is held
                fresh = sum(len(n) for n, _ in held.values())
                if fresh > MOST_HELD // 2:
                    yield from sent()
                    fresh = 0
    yield from sent()


def _share(count: Column, total: Column) -> Column:
    """1 + floor(SCALE * (count + 1) / total), in whole numbers of up to 38 digits."""
    top = F.lit(SCALE).cast("decimal(10,0)") * (count + 1).cast("decimal(20,0)")
    return F.call_function("div", top, total.cast("decimal(20,0)")) + 1


def _surplus(p: Column, q: Column) -> Column:
    """floor((p - q)^2 / q); shares are at most SCALE + 1, so a square fits a long."""
    return F.call_function("div", (p - q) * (p - q), q)


def term_counts(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """Per lang, source and kept term with an occurrence there: c, l (occurrences in the language), first.

    A row is a document; a term is kept where ``min_documents`` rows of its language hold it.
    ``first`` is true for one row of each language and term. Words are counted in each task and
    dealt out once, by language and term: a frequent word is a row per task and source by then.
    """
    rows = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), "text")
    sent = rows.mapInArrow(_counted, "lang string, source string, term string, n long, documents long")
    counts = (sent.repartition("lang", "term").groupBy("lang", "source", "term")
              .agg(F.sum("n").alias("c"), F.sum("documents").alias("documents")))
    same = Window.partitionBy("lang", "term")
    return (counts.select("lang", "source", "term", "c", F.sum("c").over(same).alias("l"),
                          F.sum("documents").over(same).alias("documents"),
                          (F.row_number().over(same.orderBy("source")) == 1).alias("first"))
            .filter(F.col("documents") >= min_documents).drop("documents"))


def _groups(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """Every lang and source of ``docs``: total and lang_total (what counts are divided by), v, zero (share of no occurrence)."""
    groups = docs.select(F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source")).distinct()
    own = kept.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    lang = kept.groupBy("lang").agg(F.sum("c").alias("lang_n"), F.sum(F.col("first").cast("long")).alias("v"))
    # Only groups of a language that kept a term: else there is nothing to divide by.
    found = groups.join(lang, "lang").join(own, ["lang", "source"], "left").select(
        "lang", "source", "v", (F.coalesce("n", F.lit(0)) + F.col("v")).alias("total"),
        (F.col("lang_n") + F.col("v")).alias("lang_total"))
    found = found.withColumn("zero", _share(F.lit(0), F.col("total")))
    return groups.join(found, ["lang", "source"], "left")


def _pairs(kept: DataFrame, groups: DataFrame, salts: int) -> DataFrame:
    """lang, source, item (another source), value: the surplus of source over item, over all kept terms.

    A term that neither has gives what two zero counts give; a term of one of them differs from
    that by a sum over the counts of this one alone; only terms that both have are joined.
    """
    priced = kept.join(groups.select("lang", "source", "total", "zero"), ["lang", "source"]).select(
        "lang", "source", "term", _share(F.col("c"), F.col("total")).alias("p"), "zero")
    a, b = (priced.select("lang", "term", *[F.col(c).alias(f"{side}_{c}") for c in ("source", "p", "zero")]) for side in "ab")
    both = a.join(b, ["lang", "term"]).filter("a_source < b_source")

    def more(one: str, two: str) -> Column:
        p, p0, q, q0 = (F.col(f"{side}_{c}") for side in (one, two) for c in ("p", "zero"))
        return _surplus(p, q) - _surplus(p, q0) - _surplus(p0, q) + _surplus(p0, q0)

    common = both.groupBy("lang", "a_source", "b_source").agg(F.sum(more("a", "b")).alias("there"), F.sum(more("b", "a")).alias("back"))

    # Salted: a language is one key, with as many rows as its sources have different counts.
    counts = priced.groupBy("lang", "source", "zero", "p").agg(F.count("*").alias("m")).select(
        "lang", F.pmod("p", F.lit(salts)).alias("salt"), F.col("source").alias("a_source"), F.col("zero").alias("a_zero"), "p", "m")
    others = groups.select("lang", F.col("source").alias("b_source"), F.col("zero").alias("b_zero"), "v")
    dealt = others.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    p, p0, q0, m = F.col("p"), F.col("a_zero"), F.col("b_zero"), F.col("m")
    single = counts.join(dealt, ["lang", "salt"]).filter("a_source <> b_source").groupBy("lang", "a_source", "b_source").agg(
        F.sum(m * (_surplus(p, q0) - _surplus(p0, q0))).alias("there"),
        F.sum(m * (_surplus(q0, p) - _surplus(q0, p0))).alias("back"))

    def ways(df: DataFrame) -> DataFrame:
        way = F.array(*[F.struct(F.col(a).alias("source"), F.col(b).alias("item"), F.col(sum_).alias("value"))
                        for a, b, sum_ in (("a_source", "b_source", "there"), ("b_source", "a_source", "back"))])
        return df.select("lang", F.explode(way).alias("way")).select("lang", "way.*")

    none = (groups.select("lang", F.col("source").alias("a_source"), F.col("zero").alias("a_zero"))
            .join(others, "lang").filter("a_source <> b_source")
            .select("lang", F.col("a_source").alias("source"), F.col("b_source").alias("item"),
                    F.coalesce(F.col("v") * _surplus(F.col("a_zero"), F.col("b_zero")), F.lit(0).cast("long")).alias("value")))
    return (none.unionByName(ways(single)).unionByName(ways(common))
            .groupBy("lang", "source", "item").agg(F.sum("value").alias("value")))


def _terms(kept: DataFrame, groups: DataFrame, limit: int, salts: int) -> DataFrame:
    """lang, source, item (a term above its share in the language), value: what can reach the first ``limit`` ranks.

    Terms of equal counts in source and language are one cell. Cells of equal value are merged;
    values are ranked by how many terms stand before them, and the terms of those that begin
    within the limit are looked up, at most ``limit`` of a value and salt.
    """
    cells = kept.groupBy("lang", "source", "c", "l").agg(F.count("*").alias("m"))
    p, q = F.col("p"), F.col("q")
    cells = cells.join(groups.select("lang", "source", "total", "lang_total"), ["lang", "source"]).select(
        "lang", "source", "c", "l", "m", _share(F.col("c"), F.col("total")).alias("p"),
        _share(F.col("l"), F.col("lang_total")).alias("q"))
    cells = shared_table(cells.filter(p > q).select("lang", "source", "c", "l", "m", _surplus(p, q).alias("value")))

    values = cells.groupBy("lang", "source", "value").agg(F.sum("m").alias("m"))
    salted = Window.partitionBy("lang", "source", F.pmod(F.xxhash64("value"), F.lit(salts))).orderBy(F.desc("value"))
    # A value is a term at least, so what lies behind `limit` values of one salt is behind them all.
    values = values.withColumn("r", F.row_number().over(salted)).filter(F.col("r") <= limit)
    earlier = Window.partitionBy("lang", "source").orderBy(F.desc("value")).rowsBetween(Window.unboundedPreceding, -1)
    values = values.withColumn("before", F.coalesce(F.sum("m").over(earlier), F.lit(0))).filter(F.col("before") < limit)
    chosen = shared_table(cells.drop("m").join(values.select("lang", "source", "value", "before"), ["lang", "source", "value"]))

    place = Window.partitionBy("lang", "source", "value", F.pmod(F.xxhash64("term"), F.lit(salts))).orderBy("term")
    return (kept.join(chosen, ["lang", "source", "c", "l"]).withColumn("r", F.row_number().over(place))
            .filter(F.col("r") <= limit - F.col("before")).select("lang", "source", F.col("term").alias("item"), "value"))


def audit_sources(docs: DataFrame, min_documents: int = MIN_DOCUMENTS, limit: int = LIMIT, salts: int = SALTS) -> DataFrame:
    """lang, source, part (pair, term), item, value, rank: how each source of a language differs.

    Every lang gives each kept term (see ``term_counts``) and every (lang, source) of ``docs`` a
    share p = 1 + floor(10^9 (count + 1) / (N + V)), N the occurrences of kept terms there, V the
    number of kept terms. ``pair``: f(p, q) = floor((p - q)^2 / q) summed over all kept terms, q of
    the other source; 0 where nothing is kept. ``term``: f against the language for each term that
    the source has and that has a larger share there, down to rank ``limit``. Ranks go by value,
    falling, then by item in UTF-8 order.

    Null text, lang and source count as empty; repeated rows are documents of their own; further
    columns are not read; an empty table gives an empty result.
    """
    with scratch(docs.sparkSession):
        kept = shared_table(term_counts(docs, min_documents))
        groups = shared_table(_groups(docs, kept))
        ranked = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")

        def part(name: str, df: DataFrame) -> DataFrame:
            return df.select("lang", "source", F.lit(name).alias("part"), "item", "value", F.row_number().over(ranked).alias("rank"))

        terms = part("term", _terms(kept, groups, limit, salts)).filter(F.col("rank") <= limit)
        return shared_table(part("pair", _pairs(kept, groups, salts)).unionByName(terms), stays=True)
