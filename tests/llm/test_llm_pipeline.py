"""The five stages on a small corpus, each against what its own brute force would keep."""

import importlib
import random

import pytest

import __spark_entry__ as entry_points
from wellspark.llm import mixing
from wellspark.llm.shared import fraction
from test_llm_decontamination import brute as leaks
from test_llm_jaccard import brute as groups
from test_llm_lines import brute as lines
from test_llm_mixing import smallest


def corpus():
    rng = random.Random(11)
    syllables = ["ta", "ri", "no", "lem", "sor", "vek", "un", "dor"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 4)))
    text = lambda n: [word() for _ in range(n)]
    items = [(k, " ".join(text(30))) for k in range(3)]
    rows, labels = [], []
    for i in range(400):
        words = text(rng.randint(30, 90))
        toxic = i % 7 == 0
        if toxic:
            for _ in range(4):
                words[rng.randrange(len(words))] = "zgrim" + word()
        t = " ".join(words)
        if i % 5 == 1:
            t += "\nall rights reserved by nobody\nown line " + word()
        if i % 40 == 3:
            t = f"{t[:80]} {items[i % 3][1]} {t[80:]}"
        rows.append((i, t, "en", "big" if i % 3 else "small", len(t)))
        labels.append((i, 1, int(toxic)))
    for i in range(400, 430):
        source = rows[i - 390]
        rows.append((i, source[1] + " more", *source[2:]))
    rows += [(500, None, None, "small", None), (501, "", "de", "small", 0), (502, "x", "de", "big", 1)]
    return rows, labels, items


def test_stages_against_brute_force(spark, tmp_path, rows):
    pipeline = importlib.import_module("corpus_pipeline")
    data, labels, items = corpus()
    kinds = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame(data, kinds).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert [n for n, _ in pipeline.STAGES] == ["toxicity", "line_dedup", "ngram_jaccard_join", "benchmark_decontamination", "source_mixing"]
    docs, kept, now = spark.read.parquet(f"{tmp_path}/documents.parquet"), [], data
    for k, (_, stage) in enumerate(pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        assert docs.dtypes[:5] == spark.createDataFrame([], kinds).dtypes
        docs.write.parquet(f"{tmp_path}/{k}")
        docs = spark.read.parquet(f"{tmp_path}/{k}")
        before, now = now, sorted((tuple(r)[:5] for r in docs.collect()), key=lambda r: r[0])
        kept.append(now)
        by_id = {r[0]: r for r in before}
        if k == 0:
            toxic = {i for i, *_ in data if (i < 400 and i % 7 == 0) or (400 <= i < 430 and (i - 390) % 7 == 0)}
            assert [r[0] for r in now] == [i for i, *_ in data if i not in toxic]
        elif k == 1:
            want = {i: t for i, t, _, n in lines([r[:2] for r in before], 10) if n}
            assert want and now == [(i, want.get(i, t), *rest, len(want[i]) if i in want else n) for i, t, *rest, n in before]
        elif k == 2:
            assert [r[0] for r in now] == [i for i, _, c in groups([r[:2] for r in before]) if i == c] and len(now) < len(before)
        elif k == 3:
            bad = {i for i, _, _ in leaks([r[:2] for r in before], items)}
            assert bad and now == [r for r in before if r[0] not in bad]
        else:
            frame = spark.createDataFrame(before, kinds)
            rate = {r["source"]: r["rate"] for r in mixing.repetition_rates(frame).collect()}
            u = {r[0]: r[1] for r in frame.select("doc_id", fraction("mix 0", "doc_id", "text")).collect()}
            assert now == [by_id[i] for i in sorted(by_id) for _ in range(smallest(rate[by_id[i][3]], u[i]))]
    assert sorted(tuple(r)[:5] for r in pipeline.run(spark, str(tmp_path)).select("doc_id", "doc_id", "doc_id", "doc_id", "doc_id").collect()) == [
        (r[0],) * 5 for r in kept[-1]]


def test_every_operator_has_one_query():
    names = list(entry_points.queries())
    assert [sum(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)] == [1] * 10 and "pipeline" in names


@pytest.mark.parametrize("empty", ["documents", "labels", "benchmark"])
def test_empty_tables(spark, tmp_path, empty):
    pipeline = importlib.import_module("corpus_pipeline")
    data, labels, items = corpus()
    frames = {"documents": spark.createDataFrame(data[:40], "doc_id long, text string, lang string, source string, n_chars long"),
              "labels": spark.createDataFrame(labels[:40], "doc_id long, quality int, toxic int"),
              "benchmark": spark.createDataFrame(items, "item_id long, text string")}
    for name, frame in frames.items():
        (frame.limit(0) if name == empty else frame).write.parquet(f"{tmp_path}/{name}.parquet")
    assert (pipeline.run(spark, str(tmp_path)).count() == 0) == (empty == "documents")
