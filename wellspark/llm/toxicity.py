"""Toxicity by two class-conditional Kneser-Ney models over the letters of words."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.llm.shared import FOLDS, fold, fraction, scratch, shared_table, text_bytes

MOST_LABELLED = 4_000  # rows of each label that the counts, and again the threshold, are fitted on
ORDER = 6  # letters of the longest string that is counted
SHARED = 2  # strings of so many letters have one count for both models
LEAST = 2  # a rarer string is left to the backoff
DISCOUNT = 0.75
START, END = "^", "$"
MOST_CACHED = 400_000  # words whose ratio a worker remembers
_WORD = re.compile(r"[^\W\d_]+")


def words(text: bytes) -> list[str]:
    """Runs of letters, in lower case."""
    return _WORD.findall(text.decode("utf-8", "replace").lower())


def strings(word: str):
    """Every string of up to ORDER letters in the word between its start and end marks."""
    marked = f"{START}{word}{END}"
    for end in range(2, len(marked) + 1):
        for size in range(1, min(ORDER, end) + 1):
            yield marked[end - size:end]


@dataclass
class Model:
    """Log ratios, toxic over ordinary, of a string's last letter after the others and of backing off.

    Strings and contexts are sorted arrays with a ratio each; a worker makes dictionaries of them.
    """

    strings: np.ndarray
    string_ratios: np.ndarray
    contexts: np.ndarray
    context_ratios: np.ndarray
    weights: np.ndarray = field(default_factory=lambda: np.zeros(4))
    cache: dict[str, float] = field(default_factory=dict)

    @cached_property
    def letters(self) -> dict[str, float]:
        return dict(zip(self.strings.tolist(), self.string_ratios.tolist()))

    @cached_property
    def backoff(self) -> dict[str, float]:
        return dict(zip(self.contexts.tolist(), self.context_ratios.tolist()))

    def word(self, word: str) -> float:
        """The difference of the word's log-likelihoods."""
        marked, total = f"{START}{word}{END}", 0.0
        for end in range(2, len(marked) + 1):
            s = marked[max(0, end - ORDER):end]
            ratio = self.letters.get(s)
            while ratio is None:
                total += self.backoff.get(s[:-1], 0.0)
                s = s[1:]
                ratio = self.letters.get(s) if s else 0.0
            total += ratio
        return total

    def features(self, texts: list[bytes]) -> np.ndarray:
        """Per text: mean difference per word, the same times the root of the length, the largest, 1."""
        out = np.zeros((len(texts), 4))
        out[:, 3] = 1
        known = self.cache
        for i, text in enumerate(texts):
            tokens = words(text)
            if tokens:
                ratios = [known.get(w) for w in tokens]
                for k in [k for k, r in enumerate(ratios) if r is None]:
                    w = tokens[k]
                    ratios[k] = r = self.word(w)
                    if len(w) <= 40 and len(known) < MOST_CACHED:
                        known[w] = r
                total, n = sum(ratios), len(ratios)
                out[i, :3] = total / n, total / math.sqrt(n), max(ratios)
        return out

    def scores(self, texts: list[bytes]) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.features(texts) @ self.weights, -500, 500)))

    def __getstate__(self):
        return {**{k: v for k, v in self.__dict__.items() if k not in ("letters", "backoff")}, "cache": {}}


def _first_off(strings: np.ndarray) -> np.ndarray:
    """Every string without its first letter."""
    codes = strings.view(np.uint32).reshape(len(strings), strings.dtype.itemsize // 4)
    return np.ascontiguousarray(np.hstack([codes[:, 1:], np.zeros((len(codes), 1), np.uint32)])).view(strings.dtype).ravel()


def _last_off(strings: np.ndarray) -> np.ndarray:
    """Every string without its last letter."""
    codes = strings.view(np.uint32).reshape(len(strings), strings.dtype.itemsize // 4).copy()
    size = (codes > 0).sum(axis=1)
    rows = np.flatnonzero(size)
    codes[rows, size[rows] - 1] = 0
    return codes.view(strings.dtype).ravel()


def _find(where: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in a sorted array, and whether the values are there."""
    at = np.minimum(np.searchsorted(where, what), max(len(where) - 1, 0))
    return at, where[at] == what if len(where) else np.zeros(len(what), bool)


def ratios(strings: np.ndarray, counts: np.ndarray, contexts: np.ndarray, totals: np.ndarray) -> Model:
    """The model of the strings' counts (ordinary, toxic) and the totals of their contexts.

    P(letter | context) = max(n - d, 0) / total + backoff(context) * P(letter | shorter context).
    Strings of up to SHARED letters have the same count on both sides, so the models differ only
    in what follows longer contexts and an unseen string costs both the same in the end.
    """
    order = np.argsort(strings)
    strings, counts = strings[order], counts[order]
    order = np.argsort(contexts)
    contexts, totals = contexts[order], totals[order]
    context, _ = _find(contexts, _last_off(strings))
    total = totals[context]
    kept = np.where(total > 0, np.maximum(counts - DISCOUNT, 0) / np.where(total > 0, total, 1), 0.0)
    back = np.stack([np.where(totals[:, c] > 0, np.maximum(1 - np.bincount(context, kept[:, c], len(contexts)), 1e-9), 1.0)
                     for c in (0, 1)], axis=1) if len(contexts) else np.ones((0, 2))
    chance = np.zeros((len(strings), 2))
    sizes = np.char.str_len(strings)
    for size in range(1, ORDER + 1):
        rows = np.flatnonzero(sizes == size)
        rest, factor = _first_off(strings[rows]), np.ones((len(rows), 2))
        lower, open_ = np.empty((len(rows), 2)), np.arange(len(rows))
        while len(open_):
            # Found, or nothing is left: done; else back off once more.
            at, there = _find(strings, rest[open_])
            empty = rest[open_] == ""
            lower[open_[empty]] = factor[open_[empty]] * 1e-3
            hit = there & ~empty
            lower[open_[hit]] = factor[open_[hit]] * chance[at[hit]]
            open_ = open_[~hit & ~empty]
            at, there = _find(contexts, _last_off(rest[open_]))
            factor[open_[there]] *= back[at[there]]
            rest[open_] = _first_off(rest[open_])
        chance[rows] = kept[rows] + back[context[rows]] * lower
    return Model(strings, np.log(chance[:, 1] / chance[:, 0]), contexts, np.log(back[:, 1] / back[:, 0]))


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps; x has a few columns, the last of them 1."""
    scale = np.maximum(x.std(axis=0), 1e-9)
    scale[-1] = 1
    z, w, weight = x / scale, np.zeros(x.shape[1]), weight / weight.sum()
    ridge = np.diag([*[1e-4] * (x.shape[1] - 1), 1e-9])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        slope = (z * (weight * p * (1 - p))[:, None]).T @ z + ridge + 1e-9 * np.eye(len(w))
        step = np.linalg.solve(slope, z.T @ (weight * (y - p)) - ridge @ w)
        w += np.clip(step, -2, 2)
        if abs(step).max() < 1e-6:
            break
    return w / scale


def _string_counts(texts: DataFrame) -> tuple[np.ndarray, ...]:
    """Strings, their counts by label, contexts and their totals, from rows (text, toxic).

    The longest strings and those at the start of a word count as often as they occur, shorter
    ones by the number of different letters before them, as Kneser and Ney propose.
    """
    def word_rows(batches):
        for batch in batches:
            found: dict[str, list[int]] = {}
            for text, c in zip(text_bytes(batch), batch.column(1).to_pylist()):
                for w in words(text):
                    found.setdefault(w, [0, 0])[c] += 1
            yield _count_rows(found, "word")

    def string_rows(batches):
        for batch in batches:
            found: dict[str, list[int]] = {}
            for w, a, b in zip(*(batch.column(i).to_pylist() for i in range(3))):
                for s in strings(w):
                    n = found.setdefault(s, [0, 0])
                    n[0] += a
                    n[1] += b
            yield _count_rows(found, "s")

    sums = [F.sum(c).alias(c) for c in ("n0", "n1")]
    by_word = texts.mapInArrow(word_rows, "word string, n0 long, n1 long").groupBy("word").agg(*sums)
    raw = shared_table(by_word.mapInArrow(string_rows, "s string, n0 long, n1 long").groupBy("s").agg(*sums))
    seen = [F.count_if(F.col(c) > 0).alias(f"before{i}") for i, c in enumerate(("n0", "n1"))]
    before = raw.withColumn("rest", F.expr("substring(s, 2)")).groupBy("rest").agg(*seen, F.count("*").alias("before"))
    size = F.length("s")
    plain = (size == ORDER) | F.startswith("s", F.lit(START))
    joined = raw.join(before, raw["s"] == before["rest"], "left")

    def value(c: int):
        own = F.when(plain, F.col(f"n{c}")).otherwise(F.coalesce(f"before{c}", F.lit(0)))
        return F.when(size <= SHARED, F.when(plain, F.col("n0") + F.col("n1")).otherwise(F.col("before"))).otherwise(own)

    valued = shared_table(joined.select("s", (F.col("n0") + F.col("n1")).alias("n"), value(0).cast("double").alias("v0"),
                                        value(1).cast("double").alias("v1")))
    totals = (valued.groupBy(F.expr("left(s, length(s) - 1)").alias("s"))
              .agg(F.sum("v0").alias("v0"), F.sum("v1").alias("v1"), F.max("n").alias("n")))
    rows = [t.filter(F.col("n") >= LEAST).select("s", "v0", "v1").toArrow() for t in (valued, totals)]
    return tuple(x for t in rows for x in (
        np.array(t.column(0).to_pylist(), f"<U{ORDER}"), np.stack([t.column(i).to_numpy() for i in (1, 2)], axis=1)))


def _count_rows(found: dict[str, list[int]], name: str) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(list(found), pa.string()), *(pa.array([v[c] for v in found.values()], pa.int64()) for c in (0, 1))],
        [name, "n0", "n1"])


def fit(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> Model | None:
    """The two models from labelled rows outside fold 0; None unless both labels occur there.

    Counts come from folds 1 to 3, as many rows of each label; the threshold comes from fold 4,
    which the counts have not seen. A hash of the id takes about ``most`` rows of a label where it
    has more: this documented bound on the fitted rows also bounds the model that goes to every
    task. Labels other than 0 and 1 and null ids are left out; of several labels the largest counts.
    """
    with scratch(docs.sparkSession):
        return _fit(docs, labels, most)


def _fit(docs: DataFrame, labels: DataFrame, most: int) -> Model | None:
    spark = docs.sparkSession
    marked = shared_table(labels.filter("doc_id IS NOT NULL AND toxic IN (0, 1)").groupBy("doc_id")
                          .agg(F.max("toxic").cast("int").alias("toxic")).withColumn("fold", fold()).filter("fold <> 0")
                          .withColumn("last", F.col("fold") == FOLDS - 1))
    n = {(r["last"], r["toxic"]): r["count"] for r in marked.groupBy("last", "toxic").count().collect()}
    if not n.get((False, 0)) or not n.get((False, 1)):
        return None
    even = min(most, n[False, 0], n[False, 1])
    share = {k: min(1.0, (most if k[0] else even) / v) for k, v in n.items()}
    take = F.lit(0.0)
    for (last, toxic), x in share.items():
        take = F.when((F.col("last") == last) & (F.col("toxic") == toxic), x).otherwise(take)
    chosen = marked.filter(fraction("toxicity", "doc_id") < take).select("doc_id", "toxic", "last")
    # Four times ``most`` rows of three small columns, give or take the luck of the hash.
    texts = shared_table(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic", "last"))
    model = ratios(*_string_counts(texts.filter("NOT last").select("text", "toxic")))
    sent = spark.sparkContext.broadcast(model)

    def measured(batches):
        for batch in batches:
            x = sent.value.features(text_bytes(batch))
            yield pa.RecordBatch.from_arrays([*(pa.array(x[:, i]) for i in range(3)), batch.column(1)], ["x0", "x1", "x2", "toxic"])

    rows = (texts.filter("last").select("text", "toxic")
            .mapInArrow(measured, "x0 double, x1 double, x2 double, toxic int").toArrow())
    sent.destroy()
    y = rows.column("toxic").to_numpy().astype(float)
    if 0 < y.sum() < len(y):
        x = np.stack([*(rows.column(i).to_numpy() for i in range(3)), np.ones(len(y))], axis=1)
        model.weights = logistic(x, y, np.where(y == 1, 1 / share[True, 1], 1 / share[True, 0]))
    else:
        model.weights = np.array([1.0, 0.0, 0.0, math.log(n[False, 1] / n[False, 0])])
    return model


def score_toxicity(docs: DataFrame, labels: DataFrame, most: int = MOST_LABELLED) -> DataFrame:
    """``docs`` with score (0 to 1) and predicted (1 if score >= 0.5); columns of these names go.

    A text is scored by the difference of its two log-likelihoods per word, with its length and
    its most telling word beside it, as the logistic curve fitted on fold 4 reads them. Null,
    empty and wordless texts have differences of 0. Without rows of both labels every score is 0.
    Repeated rows have equal scores; an empty table gives an empty result.
    """
    model = fit(docs, labels, most)
    others = [c for c in docs.columns if c not in ("score", "predicted")]
    if model is None:
        return docs.select(*others, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(sent.value.scores([x or b"" for x in texts.cast(pa.large_binary()).to_pylist()]))

    scored = docs.select(*others, score("text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
