import os
import random

import pytest

from wellspark.llm import tokens

PATH = "/opt/tokenizers/piece_bpe_32k.model"


def brute(v, text):
    """Viterbi over all substrings: a later start has to be better. The whole path is kept and counted at the end."""
    text = v.normal(text)
    longest = max(map(len, v.pieces))
    best = [(0.0, [])]
    for end in range(1, len(text) + 1):
        found = None
        for start in range(max(0, end - longest), end):
            piece = text[start:end]
            if piece not in v.pieces and end - start > 1:
                continue
            s = best[start][0] + v.pieces.get(piece, v.unknown)
            if found is None or s > found[0]:
                found = s, best[start][1] + [piece]
        best.append(found)
    score, path = best[-1]
    if v.byte_fallback:
        return sum(1 if p in v.pieces else len(p.encode()) for p in path), score
    return sum(p in v.pieces or i == 0 or path[i - 1] in v.pieces for i, p in enumerate(path)), score


@pytest.mark.parametrize("pieces", [
    {"▁": -3.0, "▁a": -2.0, "a": -2.0, "ab": -4.0, "b": -2.0, "▁ab": -4.0, "ba": -4.0, "aba": -6.0},
    {"a▁b": -1.0, "a": -2.0, "▁": -2.0, "b": -2.0, "▁▁": -3.0},
    {"a": -1.0, "b\n": -1.5, "▁a": -1.0, "\n": -2.0},
    {"bb": -1.0},
])
@pytest.mark.parametrize("fallback,prefix", [(True, True), (False, False)])
@pytest.mark.parametrize("remove", [False, True])
def test_ties_and_unknowns_against_brute_force(pieces, fallback, prefix, remove):
    v, rng = tokens.Vocabulary(pieces, -20.0, fallback, prefix, remove), random.Random(1)
    for _ in range(300):
        text = "".join(rng.choice("aabb  \né") for _ in range(rng.randint(0, 14)))
        assert v.measure(text) == pytest.approx(brute(v, text)), repr(text)


def unigram(pieces, user=(), fallback=False, remove=True, prefix=True, charsmap=b"", suffix=False):
    """A unigram model in memory."""
    from sentencepiece import sentencepiece_model_pb2 as model_pb2

    model = model_pb2.ModelProto()
    kinds = model_pb2.ModelProto.SentencePiece
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    model.trainer_spec.byte_fallback, model.trainer_spec.treat_whitespace_as_suffix = fallback, suffix
    spec = model.normalizer_spec
    spec.name, spec.add_dummy_prefix, spec.remove_extra_whitespaces, spec.precompiled_charsmap = "own", prefix, remove, charsmap
    listed = [("<unk>", 0, kinds.UNKNOWN), ("<s>", 0, kinds.CONTROL), ("</s>", 0, kinds.CONTROL), *[(p, 0, kinds.USER_DEFINED) for p in user],
              *[(p, s, kinds.NORMAL) for p, s in pieces.items()], *[(f"<0x{b:02X}>", 0, kinds.BYTE) for b in range(256) if fallback]]
    for piece, score, kind in listed:
        model.pieces.add(piece=piece, score=score, type=kind)
    return model.SerializeToString()


def charsmap():
    """The character map of the library's own normaliser."""
    import io

    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as model_pb2

    normalizer = sentencepiece.SentencePieceNormalizer(rule_name="nmt_nfkc")
    model = model_pb2.ModelProto()
    model.ParseFromString(normalizer.serialized_model_proto())
    return model.normalizer_spec.precompiled_charsmap


def against_the_library(proto, texts):
    import sentencepiece

    library, v = sentencepiece.SentencePieceProcessor(model_proto=proto), tokens.vocabulary_of(proto)
    for text in texts:
        assert v.measure(text)[0] == len(library.encode(text)), (text, library.encode(text, out_type=str))


def odd_texts(rng, n=150):
    words = ["the", "there", "qzxq", "a", "ab", "ꙮꙮꙮ", "ꙮ", "x  y", "日本", "ﬁne", "Ａ", "\u00a0", "\t", "\n", "é", "e\u0301", "🙂", "ba", "b"]
    return ["", " ", "   ", "ꙮꙮꙮ the", "a   b  c", "a qzxq b", " ꙮ ꙮ  ꙮ", *[
        "".join(rng.choice(words) + rng.choice(["", " ", "  ", "   "]) for _ in range(rng.randint(0, 12))) for _ in range(n)]]


@pytest.mark.parametrize("space", [True, False])
@pytest.mark.parametrize("user", [(), ("qzxq",), ("qzxq", "ab", "x  y", "é")])
@pytest.mark.parametrize("fallback,remove,prefix,mapped,suffix", [
    (False, True, True, False, False), (True, True, True, False, False), (False, False, True, False, False), (True, False, False, False, False),
    (False, True, False, True, False), (True, True, True, True, False), (False, False, False, True, False), (False, True, True, False, True)])
def test_unigram_models_as_in_the_library(space, user, fallback, remove, prefix, mapped, suffix):
    """Runs of unknown characters, blanks that are removed or kept, pieces of the user, character maps."""
    rng = random.Random(f"{space}{user}{fallback}{remove}{prefix}{mapped}")
    letters = "abtherceq" + ("▁" if space else "")
    pieces = {p: round(rng.uniform(-9, -1), 3) for p in letters}
    for _ in range(60):
        pieces.setdefault(rng.choice(["", "▁"]) + "".join(rng.choice("abthere日é") for _ in range(rng.randint(1, 4))), round(rng.uniform(-9, -2), 3))
    pieces = {p: s for p, s in pieces.items() if p not in user and (space or "▁" not in p)}
    against_the_library(unigram(pieces, user, fallback, remove, prefix, charsmap() if mapped else b"", suffix), odd_texts(rng))


def test_models_that_do_not_mark_blanks_are_refused():
    from sentencepiece import sentencepiece_model_pb2 as model_pb2

    model = model_pb2.ModelProto()
    model.ParseFromString(unigram({"a": -1.0}))
    model.normalizer_spec.escape_whitespaces = False
    with pytest.raises(ValueError):
        tokens.vocabulary_of(model.SerializeToString())


@pytest.mark.skipif(not os.path.exists(PATH), reason="no vocabulary here")
def test_counts_of_the_library(spark, documents):
    """The library's own unigram search with the same pieces and scores."""
    import sentencepiece
    from sentencepiece import sentencepiece_model_pb2 as model_pb2

    v = tokens.load_vocabulary(PATH)
    model = model_pb2.ModelProto()
    with open(PATH, "rb") as f:
        model.ParseFromString(f.read())
    model.trainer_spec.model_type = model.trainer_spec.UNIGRAM
    for p in model.pieces:
        if p.piece in v.pieces and p.type == p.NORMAL:
            p.score = v.pieces[p.piece]
    library = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())
    rng = random.Random(7)
    words = ["the", "there", "continue", "naïve", "日本語", "x" * 60, "  ", "\n", "Ω", "🙂", "don't", "1234.5", "überall", "\t"]
    texts = ["".join(rng.choice(words) + rng.choice([" ", "", "  "]) for _ in range(rng.randint(0, 60))) for _ in range(200)]
    got = {r["doc_id"]: r["n_tokens"] for r in tokens.count_tokens(documents(texts), v).collect()}
    assert got == {i: len(library.encode(t)) for i, t in enumerate(texts)}


def test_nulls_repeated_rows_clashing_columns_and_long_texts(spark, rows):
    v = tokens.Vocabulary({"▁a": -1.0, "a": -1.0}, -11.0, True, True)
    data = [(1, "a a", "x")] * 2 + [(None, None, "y"), (2, "", "z"), (3, "é", None), (4, "a" * 100_000, None)]
    docs = spark.createDataFrame(data, "doc_id long, text string, n_tokens string")
    out = tokens.count_tokens(docs, v)
    assert rows(out, "doc_id", "n_tokens") == sorted([(1, 2), (1, 2), (None, 0), (2, 0), (3, 5), (4, 100_000)], key=repr)
    assert tokens.count_tokens(docs.limit(0), v).count() == 0
