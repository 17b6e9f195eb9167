"""Every stage of the pipeline on awkward tables."""

import corpus_pipeline
import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, u long, root int, run int, part int, length long, id long, y int"
TEXTS = [None, "", "  \n ", "Ana ero ist un bana. " * 20, "Ana ero ist un bana. " * 20, "a", "word " * 50_000, "Cero dist fun gana hero. " * 30]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(0, 1, None), (None, 0, 1), (3, None, 0), (5, 0, 0), (7, 1, 0), (7, 1, 0), (4, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, "Cero dist fun gana hero. Cero dist fun gana hero.", "x"), (2, None, "x"), (None, "", "x")], "item_id long, text string, doc_id string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def rows(texts):
    out = [(i, t, None, None if i % 2 else "s", None, "x", 1, 1, 1, 1, 1, 1, 1) for i, t in enumerate(texts)]
    return [*out, (None, "no id", "en", "s", 5, "x", 1, 1, 1, 1, 1, 1, 1), out[0], out[3]] if out else out


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_awkward_rows(spark, folder, name, stage):
    docs = spark.createDataFrame(rows(TEXTS), SCHEMA)
    out = stage(spark, docs, folder)
    got = out.collect()
    ids = [r["doc_id"] for r in got]
    if name == "best_fit_packing":
        assert set(ids) == {None, *range(len(TEXTS))}
        return
    assert out.columns == docs.columns
    assert set(ids) <= {None, *range(len(TEXTS))} and len(got) <= len(TEXTS) + 3
    if name == "line_dedup":
        assert len(got) == len(TEXTS) + 3
    if name == "simhash_near_dedup":
        assert set(ids) == {0, 3, 5, 6, 7, None} and ids.count(3) == 2
    if name == "benchmark_decontamination":
        assert set(ids) == {None, *range(7)}


@pytest.mark.parametrize(("name", "stage"), corpus_pipeline.STAGES)
def test_no_rows(spark, folder, name, stage):
    assert stage(spark, spark.createDataFrame([], SCHEMA), folder).count() == 0


def test_a_process_keeps_things_of_one_stage():
    import weakref

    import pandas as pd

    from tidemark.llm import simhash, tokens

    path = tokens.vocabulary("word_bpe_49k.json")
    held = weakref.ref(tokens.encoder(path, False))
    assert tokens.encoder(path, False) is held()
    (got,) = simhash._features_udf.func(iter([pd.Series(["one two three four five six"])]))
    assert len(got) == 1 and held() is None
    again = tokens.encoder(path, False)
    assert b"".join(again.encode(["one two"])) and tokens.encoder(path, False) is again
