"""Operators and stages on tables whose columns have the names of working columns, and on repeated and null ids."""

import math

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from souk.llm import pitman_yor

#: Names that operators or stages use themselves, also in other letters.
NAMES = (
    "score lang_pred Bits_Per_Byte _row row _cuts _cut_words _of _spans given full cut_key rest _domain _lang _source "
    "_at_domain leaf_given epochs domain fp component_id digest start stop tokens hash item_id values"
).split()
BENCHMARK = "benchmark"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("odd"))
    question = "How many apples does a farmer have after selling 12 of the 40 apples in the barn today"
    spark.createDataFrame([(1, question)], "item_id long, text string").write.parquet(f"{path}/{BENCHMARK}.parquet")
    return path


@pytest.fixture(scope="module")
def docs(spark):
    shared = " ".join(f"shared{k} passage{k * 7 % 11}" for k in range(80))
    rows = [(k, f"document {k} " + " ".join(f"word{k}x{j}" for j in range(30)), "en", "web") for k in range(8)]
    rows += [(20 + k, f"opening{k} here {shared} closing{k} there " * (k + 1), "en", "web") for k in range(2)]
    rows += [(None, "no id but a text of its own", "en", "web"), (3, "a second text of id three", None, None), (30, None, "en", "web"), (31, "", "en", "web")]
    rows = [(*r, len(r[1] or "")) for r in rows]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars int")
    marks = [F.concat(F.lit(f"{name}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("none"))).alias(name) for name in NAMES]
    return df.select("*", *marks).repartition(3)


@pytest.mark.parametrize("name", [name for name, _ in corpus_pipeline.STAGES])
def test_stages_keep_columns_named_like_their_own(spark, docs, folder, name):
    out = dict(corpus_pipeline.STAGES)[name](spark, docs, folder)
    own = ("domain", "epochs") if name == "mix" else ()
    assert out.columns == [c for c in docs.columns if c not in own] + list(own)
    rows = out.collect()
    assert rows
    for row in rows:
        mark = "none" if row.doc_id is None else row.doc_id
        assert all(row[c] == f"{c}:{mark}" for c in NAMES if c not in own)


def test_scores_are_those_of_each_row(spark):
    texts = [(None, "a b"), (None, "a b c a b c a"), (5, "b"), (5, "c c c c"), (5, "c c c c"), (6, None)]
    df = spark.createDataFrame(texts, "doc_id long, text string").repartition(2)
    got = pitman_yor.score(df, F.lit(True)).collect()
    lengths = sorted((r.doc_id or 0, r.n_tokens) for r in got)
    assert lengths == sorted((i or 0, len((t or "").split()) + 1) for i, t in texts)
    n, v = 6 + 18, 4  # ends and words; a, b, c and the end
    counts = {"a": 4, "b": 4, "c": 10}
    for r in got:
        if r.doc_id is None and r.n_tokens == 3:
            plain = sum(math.log10((c + 1) / (n + v + 1)) for c in (counts["a"], counts["b"], 6))
            assert r.base_score == pytest.approx(plain)
    assert len({(r.n_tokens, r.score) for r in got if r.doc_id == 5}) == 2
