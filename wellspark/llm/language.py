"""Language identification by prediction by partial matching over bytes."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wellspark.llm.shared import fold, fraction, scratch, shared_table, text_bytes

ORDER = 3  # bytes of the longest context
SAMPLE_BYTES = 6_000_000  # of each language's training texts that its tree is fitted on, about
LEAST = 2  # a context that was seen less often has no node
UNDETERMINED = "und"
_CHUNK = 1 << 18  # bytes that are scored at a time


@dataclass
class Trees:
    """The context trees of all languages, frozen.

    ``symbol`` maps a byte to its class (0: in no training text), ``node`` the classes of the last
    ORDER bytes to a row of ``bits``: code length of each class by language.
    """

    languages: list[str]
    symbol: np.ndarray
    node: np.ndarray
    bits: np.ndarray

    def lengths(self, texts: list[bytes]) -> np.ndarray:
        """Bits that each tree takes for each text, a row per text."""
        size = self.bits.shape[1]
        out = np.zeros((len(texts), len(self.languages)))
        table = self.bits.reshape(-1, len(self.languages))
        sizes = np.array([len(t) for t in texts], np.int64)
        data = np.frombuffer(b"".join(b"\n" * ORDER + t for t in texts), np.uint8)
        owner = np.repeat(np.arange(len(texts)), sizes + ORDER)
        begin = np.cumsum(sizes + ORDER) - sizes - ORDER
        inside = np.arange(len(data)) - begin[owner] >= ORDER
        s = self.symbol[data].astype(np.int64)
        for lo in range(ORDER, len(data), _CHUNK):
            hi = min(lo + _CHUNK, len(data))
            context = np.zeros(hi - lo, np.int64)
            for back in range(ORDER, 0, -1):
                context = context * size + s[lo - back:hi - back]
            at = self.node[context].astype(np.int64) * size + s[lo:hi]
            mine = inside[lo:hi]
            who = owner[lo:hi][mine]
            if len(who):
                starts = np.flatnonzero(np.concatenate([[True], who[1:] != who[:-1]]))
                out[who[starts]] += np.add.reduceat(table[at[mine]], starts, axis=0, dtype=np.float64)
        return out


def build_trees(languages: list[str], counts: dict[str, tuple[np.ndarray, np.ndarray]]) -> Trees:
    """Trees from counts: per language the strings of ORDER + 1 bytes, as numbers, and how often.

    In a context of n bytes seen, q of them different, byte b has the chance c(b) / (n + q) and
    the escape to the context without its first byte q / (n + q); bytes that a longer context
    offers are left out after its escape. Below the empty context all 256 bytes are equally
    likely. These are code lengths of method C with exclusion, for statistics that do not change.
    """
    seen = np.zeros(256, bool)
    for strings, _ in counts.values():
        for i in range(ORDER + 1):
            seen[(strings >> (8 * i)) & 255] = True
    seen[10] = True
    symbol = np.zeros(256, np.int16)
    symbol[seen] = np.arange(1, seen.sum() + 1)
    size = int(seen.sum()) + 1

    def levels(strings: np.ndarray, n: np.ndarray):
        """Per order k: (contexts as base-size numbers, sorted) and a table contexts x classes."""
        classes = [symbol[(strings >> (8 * i)) & 255].astype(np.int64) for i in range(ORDER + 1)]
        for k in range(ORDER + 1):
            context = np.zeros(len(strings), np.int64)
            for back in range(k, 0, -1):
                context = context * size + classes[back]
            names, row = np.unique(context, return_inverse=True)
            table = np.zeros((len(names), size))
            np.add.at(table, (row, classes[0]), n)
            often = (table.sum(axis=1) >= LEAST) | (k == 0)
            yield names[often], table[often]

    by_language = [list(levels(*counts[x])) for x in languages]
    names = [np.unique(np.concatenate([lv[k][0] for lv in by_language])) for k in range(ORDER + 1)]
    offset = np.cumsum([0, *map(len, names)])
    bits = np.zeros((offset[-1], size, len(languages)), np.float32)
    for j, tree in enumerate(by_language):
        # The class of bytes that no text has stands for all of them; each one's chance is alike.
        for k in range(ORDER + 1):
            known = dict(zip(tree[k][0].tolist(), range(len(tree[k][0]))))
            for i, name in enumerate(names[k].tolist()):
                if name not in known:  # the longest context that this language has
                    shorter = name % size ** (k - 1) if k > 1 else 0
                    bits[offset[k] + i, :, j] = bits[offset[k - 1] + np.searchsorted(names[k - 1], shorter), :, j] if k else 8.0
                    continue
                bits[offset[k] + i, :, j] = _code_lengths(tree, k, name, size)
    # Contexts that are nowhere a node fall back to their last bytes.
    node = np.zeros(1, np.int64)
    for k in range(1, ORDER + 1):
        node = np.tile(node, size)
        node[names[k]] = offset[k] + np.arange(len(names[k]))
    return Trees(languages, symbol, node.astype(np.int32), bits)


def _code_lengths(tree, k: int, name: int, size: int) -> np.ndarray:
    """Bits of every class after the context ``name`` of k bytes, by escapes down to no context."""
    out = np.full(size, np.nan)
    excluded = np.zeros(size, bool)
    spent = 0.0
    for order in range(k, -1, -1):
        context = name % size ** order if order else 0
        contexts, table = tree[order]
        row = np.searchsorted(contexts, context)
        if row == len(contexts) or contexts[row] != context:
            continue
        c = np.where(excluded, 0, table[row])
        n, q = c.sum(), (c > 0).sum()
        if not q:
            continue
        hit = c > 0
        out[hit] = spent - np.log2(c[hit] / (n + q))
        spent += -math.log2(q / (n + q))
        excluded |= hit
    rest = np.isnan(out)
    out[rest] = spent + math.log2(max(1, 256 - int(excluded[1:].sum())))
    return out


def fit(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> Trees | None:
    """Trees of the languages of ``docs`` (doc_id, text, lang) outside fold 0; None without any.

    A hash of the id takes about ``sample_bytes`` of the texts of a language that has more, one
    text at least: this documented bound on the fitted rows also bounds the trees that go to
    every task.
    """
    with scratch(docs.sparkSession):
        return _fit(docs, sample_bytes)


def _fit(docs: DataFrame, sample_bytes: int) -> Trees | None:
    training = docs.filter("lang IS NOT NULL AND text IS NOT NULL AND text <> ''").filter(fold() != 0).select("doc_id", "text", "lang")
    draw = fraction("language", "doc_id", "text")
    sizes = shared_table(training.groupBy("lang").agg(F.sum(F.octet_length("text")).alias("bytes"), F.min(draw).alias("_least"))
                         .withColumn("_take", F.lit(float(sample_bytes)) / F.col("bytes")))
    # A language of a few very long texts keeps the one that is drawn first.
    chosen = training.join(sizes.select("lang", "_take", "_least"), "lang").filter((draw < F.col("_take")) | (draw == F.col("_least")))

    def strings(batches):
        for batch in batches:
            found: dict[str, list[np.ndarray]] = {}
            for text, lang in zip(text_bytes(batch), batch.column(1).to_pylist()):
                data = np.frombuffer(b"\n" * ORDER + text, np.uint8).astype(np.int64)
                value = np.zeros(len(text), np.int64)
                for i in range(ORDER + 1):
                    value = value << 8 | data[i:i + len(text)]
                found.setdefault(lang, []).append(value)
            for lang, values in found.items():
                s, n = np.unique(np.concatenate(values), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(s)), pa.array(s), pa.array(n)], ["lang", "s", "n"])

    counts = (chosen.select("text", "lang").mapInArrow(strings, "lang string, s long, n long")
              .groupBy("lang", "s").agg(F.sum("n").alias("n")).toArrow())
    lang = np.array(counts.column("lang").to_pylist(), object)
    s, n = counts.column("s").to_numpy(), counts.column("n").to_numpy().astype(float)
    languages = sorted(set(lang.tolist()))
    return build_trees(languages, {x: (s[lang == x], n[lang == x]) for x in languages}) if languages else None


def identify(docs: DataFrame, sample_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """``docs`` with lang_pred and score (0 to 1); columns of these names are replaced.

    lang_pred is the language whose tree needs the fewest bits for the whole text, of equal ones
    the first by name; score is its probability, all languages being equally likely beforehand.
    A text that is null or has no letter is ``und`` with score 0, and so is every text where no
    language can be learned. Repeated rows have equal results.
    """
    trees = fit(docs.select("doc_id", "text", "lang"), sample_bytes)
    others = [c for c in docs.columns if c not in ("lang_pred", "score")]
    if trees is None:
        return docs.select(*others, F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    sent = docs.sparkSession.sparkContext.broadcast(trees)

    @F.arrow_udf("struct<lang_pred: string, score: double>")
    def predict(texts: pa.Array) -> pa.Array:
        rows = [x or b"" for x in texts.cast(pa.large_binary()).to_pylist()]
        names, scores = [], []
        for i in range(0, len(rows), 256):
            part = rows[i:i + 256]
            bits = sent.value.lengths(part)
            best = bits.argmin(axis=1)
            chance = 1 / np.exp2(-np.minimum(bits - bits.min(axis=1, keepdims=True), 1000)).sum(axis=1)
            for text, j, p in zip(part, best, chance):
                letter = any(map(str.isalpha, text.decode("utf-8", "replace")))
                names.append(sent.value.languages[j] if letter else UNDETERMINED)
                scores.append(float(p) if letter else 0.0)
        return pa.StructArray.from_arrays([pa.array(names, pa.string()), pa.array(scores, pa.float64())], ["lang_pred", "score"])

    return docs.withColumn("_llm_found", predict("text")).select(*others, "_llm_found.lang_pred", "_llm_found.score")
