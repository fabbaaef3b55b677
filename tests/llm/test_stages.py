"""The stages of the pipeline on repeated ids, null ids, clashing columns and empty tables."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from fieldkpi.llm import classifier, contamination, frames, mixing, neardup, passages

CLASH = "_searched _judged times rows _id _copy _kept _rows _spans key doc id clean score".split()


@pytest.fixture(autouse=True)
def _importable(spark):
    frames.importable(spark)


def prose(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(f"w{draw.randrange(5000)}" for _ in range(n))


def table(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def clashing(docs):
    return docs.select("*", F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).cast("long").alias("n_chars"), *[F.lit(f"={c}").alias(c) for c in CLASH])


def test_rows_of_a_repeated_id_are_documents_of_their_own(spark):
    rows = [(1, prose(1, 80)), (5, prose(1, 80)), (5, prose(2, 80)), (5, prose(2, 80)), (None, prose(1, 80)), (7, None)]
    left = sorted((r.doc_id or 0, r.text or "") for r in neardup.deduplicated(table(spark, rows)).collect())
    assert left == sorted([(1, prose(1, 80)), (5, prose(2, 80)), (0, prose(1, 80)), (7, "")])


def test_passages_are_cut_from_the_row_that_holds_them(spark):
    passage, clean = prose(3, 60), prose(4, 150)
    rows = [(1, prose(5, 100) + " " + passage), (2, clean), (2, prose(6, 90) + " " + passage)]
    docs = table(spark, rows)
    assert {(r.doc_id, r.other_id, r.start_word, r.end_word) for r in passages.passages(docs).collect()} == {(2, 1, 90, 150)}
    left = sorted((r.doc_id, len(r.text.split())) for r in passages.without_repeats(docs).collect())
    assert left == [(1, 160), (2, 90), (2, 150)]


def test_numbers_of_rows(spark):
    most = (1 << 63) - 1
    rows = [(most, "a"), (most, "b"), (most, "b"), (0, "c"), (None, "d"), (None, "d")]
    got = frames.keyed(table(spark, rows), "k").collect()
    keys = [r.k for r in got if r.k is not None]
    assert len(got) == 6 and len(set(keys)) == len(keys) == 4 and {0, most} <= set(keys)
    with pytest.raises(OverflowError):
        frames.keyed(table(spark, [*rows, (-most - 1, "e")]), "k")


def test_columns_of_any_name_stay(spark):
    rows = [(i, prose(10 + i, 60)) for i in range(8)] + [(8, prose(10, 60)), (None, prose(99, 60)), (9, None), (9, "")]
    docs = clashing(table(spark, rows))
    benchmark = spark.createDataFrame([(1, " ".join(prose(11, 60).split()[10:30]))], "item_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(8)], "doc_id long, quality int")
    kept = {
        "quality": classifier.accepted(docs, labels, threshold=0.0),
        "near_duplicates": neardup.deduplicated(docs),
        "passages": passages.without_repeats(docs),
        "clean": contamination.clean(docs, benchmark),
        "mixed": mixing.mixed(docs, weights=(1.0,)),
    }
    for name, out in kept.items():
        assert out.columns == docs.columns, name
        assert all(r[c] == f"={c}" for r in out.collect() for c in CLASH), name
    assert [kept[n].count() for n in ("quality", "near_duplicates", "passages", "clean")] == [12, 11, 12, 11]


def test_stages_on_empty_tables_and_null_ids(spark, tmp_path):
    for name, schema in {"labels": "doc_id long, quality int, toxic int", "benchmark": "item_id long, text string"}.items():
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    for rows in ([], [(None, None), (None, "a b c"), (3, ""), (3, ""), (3, prose(1, 50))]):
        docs = table(spark, rows).select("*", F.lit("en").alias("lang"), F.lit(None).cast("string").alias("source"), F.lit(0).cast("long").alias("n_chars"))
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = frames.written(stage(spark, docs, str(tmp_path)), "stage")
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns, name
            docs = out
        assert docs.count() == len(rows)
