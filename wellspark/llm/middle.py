"""Fill-in-middle: texts cut at two units and put together in another order, by counted quantifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNIT = "[A-Za-z]+|[^A-Za-z]"
MARKS = PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 1
PLAIN_PERCENT = 10  # documents left as they are
SPM_PERCENT = 20  # of the others, those that begin with the suffix

# A possessive group is gone through in a loop, so the length of a text costs no stack.
_UNITS = "(?:[A-Za-z]++|[^A-Za-z])"
_ORDERS = {"psm": f"{PREFIX}$1{SUFFIX}$3{MIDDLE}$2", "spm": f"{SUFFIX}$3{PREFIX}$1{MIDDLE}$2"}


def _draw(key: Column, group: int) -> Column:
    """The ``group``-th group of eight hex digits of a hash, as a number."""
    return F.conv(F.substr(key, F.lit(8 * group + 1), F.lit(8)), 16, 10).cast("long")


def cut(text: Column, first: Column, second: Column, order: Column) -> Column:
    """``text`` with ``first`` units before the middle and ``second`` in it, put in the order of ``order``.

    One match: the counts of the row are the quantifiers of its pattern.
    """
    pattern = F.concat(F.lit(rf"(?s)\A({_UNITS}{{"), first, F.lit(rf"}}+)({_UNITS}{{"), second, F.lit(r"}+)(.*)\z"))
    return F.regexp_replace(text, pattern, order)


def restore(output: Column, form: Column) -> Column:
    """The text that ``output`` was made of. Marks cannot overlap, so the first of each kind is the one put in."""
    def between(start: Column, mark: str | None = None) -> Column:
        return F.substr(output, start, F.locate(mark, output) - start) if mark else F.substr(output, start)

    after = {m: F.locate(m, output) + len(m) for m in MARKS}
    middle = between(after[MIDDLE])
    return (F.when(form == "psm", F.concat(between(after[PREFIX], SUFFIX), middle, between(after[SUFFIX], MIDDLE)))
            .when(form == "spm", F.concat(between(after[PREFIX], MIDDLE), middle, between(after[SUFFIX], PREFIX)))
            .otherwise(output))


def fill_in_middle(docs: DataFrame, seed: int = SEED, plain_percent: int = PLAIN_PERCENT,
                   spm_percent: int = SPM_PERCENT) -> DataFrame:
    """doc_id, n (units), form (plain, psm, spm), prefix_chars, middle_chars, output; a row per row.

    Both cuts and the form are drawn from the SHA-256 of seed and doc_id, so equal ids draw alike
    and a lost task draws the same again. A null id counts as the empty text. Null and empty texts
    are plain and empty; texts that hold a mark are plain. Lengths are code points, null if plain.
    Other columns of ``docs`` are not read. No shuffle; each text is matched twice.
    """
    marked = F.lit(False)
    for mark in MARKS:
        marked = marked | F.contains("text", F.lit(mark))
    key = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), 256)
    rows = (docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), key.alias("key"))
            .select("doc_id", "text", "key", F.regexp_count("text", F.lit(UNIT)).cast("long").alias("n"))
            .select("*", (_draw(F.col("key"), 0) % (F.col("n") + 1)).alias("one"),
                    (_draw(F.col("key"), 1) % (F.col("n") + 1)).alias("two"),
                    F.when((F.col("text") == "") | marked | (_draw(F.col("key"), 2) % 100 >= 100 - plain_percent), "plain")
                    .when(_draw(F.col("key"), 3) % 100 < spm_percent, "spm").otherwise("psm").alias("form")))
    order = F.when(F.col("form") == "psm", _ORDERS["psm"]).otherwise(_ORDERS["spm"])
    done = rows.select("doc_id", "n", "form", F.when(F.col("form") == "plain", F.col("text")).otherwise(
        cut(F.col("text"), F.least("one", "two"), F.abs(F.col("one") - F.col("two")), order)).alias("output"))
    place = {m: F.locate(m, F.col("output")) for m in MARKS}
    prefix = F.when(F.col("form") == "psm", place[SUFFIX] - place[PREFIX]).when(
        F.col("form") == "spm", place[MIDDLE] - place[PREFIX]) - len(PREFIX)
    middle = F.when(F.col("form") != "plain", F.length("output") + 1 - place[MIDDLE] - len(MIDDLE))
    return done.select("doc_id", "n", "form", prefix.cast("long").alias("prefix_chars"),
                       middle.cast("long").alias("middle_chars"), "output")
