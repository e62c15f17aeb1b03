"""Token counts: Viterbi over a unigram vocabulary that carries the score and the number of pieces only."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPACE = "▁"
UNKNOWN_PENALTY = 10.0  # an unknown character scores so much less than the lowest piece
USER_BYTE = 0.1  # a piece defined by the user scores so much for each byte after the first
MOST_CACHED = 500_000  # units whose result a worker remembers
LONGEST_CACHED = 48


@dataclass
class Vocabulary:
    """Pieces with scores; a run of unknown characters counts one piece, or its bytes with fallback."""

    pieces: dict[str, float]
    unknown: float
    byte_fallback: bool
    dummy_prefix: bool
    remove_spaces: bool = False
    model: bytes | None = None  # of a vocabulary whose texts the library has to normalise
    cache: dict[str, tuple[int, float, bool, bool]] = field(default_factory=dict)
    automaton: object = None
    split: object = None
    library: object = None

    def __getstate__(self):
        return {**self.__dict__, "cache": {}, "automaton": None, "split": None, "library": None}

    def normal(self, text: str) -> str:
        """The text that pieces are looked for in: blanks as the vocabulary has them, characters mapped."""
        if self.model is not None:
            if self.library is None:
                import sentencepiece

                self.library = sentencepiece.SentencePieceProcessor(model_proto=self.model)
            return self.library.normalize(text)
        if self.remove_spaces:
            text = re.sub(" {2,}", " ", text).strip(" ")
        return (SPACE if self.dummy_prefix and text else "") + text.replace(" ", SPACE)

    def units(self, text: str) -> list[str]:
        """Parts that no piece reaches across: a break is before a space that follows another character."""
        text = self.normal(text)
        if not text:
            return []
        if self.split is None:
            inner = any(SPACE in p.lstrip(SPACE) for p in self.pieces)
            lines = "" if any("\n" in p for p in self.pieces) else "\n"
            self.split = re.compile(r"(?s).+" if inner else rf"{lines or '(?!)'}|{SPACE}*[^{SPACE}{lines}]+|{SPACE}+")
        return self.split.findall(text)

    def viterbi(self, unit: str) -> tuple[int, float, bool, bool]:
        """(pieces, score, begins unknown, ends unknown) of the best path.

        Scores are summed from left to right. Of paths of equal score to a place the one whose
        last piece starts first stays, as in the tokenizer: a later start has to be better. An
        unknown character is a step of its own where no piece is that character; steps in a row
        are one piece, unless they fall back to bytes.
        """
        if self.automaton is None:
            self.automaton = ahocorasick.Automaton()
            for piece, score in self.pieces.items():
                self.automaton.add_word(piece, (len(piece), score))
            self.automaton.make_automaton()
        size = len(unit)
        score, count = [0.0] * (size + 1), [0] * (size + 1)
        opens, ends = [False] * (size + 1), [False] * (size + 1)  # whether the path's first and last step are unknown
        reached, end = 0, 0
        best, origin, known, single = None, 0, False, False

        def close(end: int) -> None:
            """Take the unknown step to ``end`` where needed and keep what is best."""
            nonlocal best, origin, known
            if not single:
                s = score[end - 1] + self.unknown
                if best is None or s > best:
                    best, origin, known = s, end - 1, False
            score[end], ends[end] = best, not known
            opens[end] = opens[origin] if origin else not known
            if known:
                count[end] = count[origin] + 1
            elif self.byte_fallback:
                count[end] = count[origin] + len(unit[origin].encode("utf-8", "replace"))
            else:
                count[end] = count[origin] + (not ends[origin])

        # Matches come by their end; those of one end from the longest, so by their start.
        for last, (length, value) in self.automaton.iter(unit):
            end = last + 1
            while reached < end:
                if reached:
                    close(reached)
                reached += 1
                best, single = None, False
            s = score[end - length] + value
            if best is None or s > best:
                best, origin, known = s, end - length, True
            single |= length == 1
        while reached <= size:
            if reached:
                close(reached)
            reached += 1
            best, single = None, False
        return count[size], score[size], opens[size], ends[size]

    def measure(self, text: str) -> tuple[int, float]:
        """(pieces, score) of a whole text, as the sums over its units; an unknown run can reach over their breaks."""
        cache, count, score, before = self.cache, 0, 0.0, False
        for unit in self.units(text):
            found = cache.get(unit)
            if found is None:
                found = self.viterbi(unit)
                if len(unit) <= LONGEST_CACHED and len(cache) < MOST_CACHED:
                    cache[unit] = found
            count += found[0] - (before and found[2] and not self.byte_fallback)
            score += found[1]
            before = found[3]
        return count, score


def load_vocabulary(path: str) -> Vocabulary:
    """The ordinary pieces of a model file; control and byte pieces match no text.

    A unigram model's scores are taken as they are, and its own pieces defined by the user at a
    tenth for each byte after the first, as the library has them. A model of merges has ranks
    instead (score 0, -1, -2, ...; whole runs of spaces far below); rank r is read as the log
    chance -ln(r + 1) that Zipf's law gives it, and what is far below as that of the last rank.
    Texts are normalised as the model says: blanks here, character maps by the library.
    """
    with open(path, "rb") as f:
        return vocabulary_of(f.read())


def vocabulary_of(proto: bytes) -> Vocabulary:
    """``load_vocabulary`` of a model in memory."""
    from sentencepiece import sentencepiece_model_pb2 as model_pb2

    model = model_pb2.ModelProto()
    model.ParseFromString(proto)
    trainer, normalizer = model.trainer_spec, model.normalizer_spec
    if not normalizer.escape_whitespaces:
        raise ValueError("models that do not mark blanks are not supported")
    unigram, size = trainer.model_type == trainer.UNIGRAM, len(model.pieces)
    normal = {p.piece: p.score if unigram else float(np.float32(-math.log1p(min(-p.score, size))))
              for p in model.pieces if p.type == p.NORMAL}
    user = {p.piece: float(np.float32(USER_BYTE * (len(p.piece.encode()) - 1))) for p in model.pieces if p.type == p.USER_DEFINED}
    lowest = np.float32(min(normal.values(), default=0.0))
    mapped = bool(normalizer.precompiled_charsmap) or trainer.treat_whitespace_as_suffix or (unigram and bool(user))
    return Vocabulary(normal | user, float(lowest - np.float32(UNKNOWN_PENALTY)), bool(trainer.byte_fallback),
                      bool(normalizer.add_dummy_prefix), bool(normalizer.remove_extra_whitespaces), proto if mapped else None)


def count_tokens(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """``docs`` with n_tokens and token_score, of the best path; columns of these names are replaced.

    Scores are summed per unit in double precision, so a word is cut alike in long and short texts.
    Null and empty texts have no tokens; repeated rows have equal results.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary)  # some ten thousand pieces

    @F.arrow_udf("struct<n_tokens: bigint, token_score: double>")
    def measure(texts: pa.Array) -> pa.Array:
        found = [sent.value.measure(t or "") for t in texts.to_pylist()]
        return pa.StructArray.from_arrays([pa.array([n for n, _ in found], pa.int64()),
                                           pa.array([s for _, s in found], pa.float64())], ["n_tokens", "token_score"])

    others = [c for c in docs.columns if c not in ("n_tokens", "token_score")]
    return docs.withColumn("_llm_counted", measure("text")).select(*others, "_llm_counted.n_tokens", "_llm_counted.token_score")
