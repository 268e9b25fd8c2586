import pytest

import corpus_pipeline
from kerbcast.llm.packing import packed
from kerbcast.llm.personal_data import all_spans

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory, prose):
    path = tmp_path_factory.mktemp("corpus")
    english = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen"
    rows = [(i, prose(i, 60), "en", "s", 1) for i in range(60)]
    rows += [(100, english, "en", "s", 1), (101, english.upper(), "en", "s", 1), (102, english + " eighteen", "en", "s", 1),
             (103, "12 34 !!", "en", "s", 1), (104, None, "en", "s", 1), (105, f"{prose(500, 30)} a.b@example.org", None, "s", 1)]
    spark.createDataFrame(rows, DOCUMENTS).write.parquet(f"{path}/documents.parquet")
    return str(path)


def test_each_stage_takes_effect(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.columns
        docs = stage(spark, docs, folder)
        assert docs.columns == before
        seen[name] = {r.doc_id: r for r in docs.collect()}
    everyone = {*range(60), 100, 101, 102, 105}
    assert set(seen["language"]) == everyone
    assert set(seen["exact_copies"]) == everyone - {100}
    assert set(seen["near_copies"]) == everyone - {100, 102}
    masked = seen["personal_data"]
    assert set(masked) == everyone - {100, 102}
    assert "[EMAIL]" in masked[105].text and masked[105].n_chars == len(masked[105].text)
    assert not any(all_spans(r.text) for r in masked.values())


def test_run_packs_what_is_left(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert {r.doc_id for r in rows} == {*range(60), 101, 105}
    alone = packed(spark.createDataFrame([(r.doc_id, "x") for r in rows], "doc_id long, text string"), corpus_pipeline.public_tokenizers.path("word_bpe_49k.json"))
    assert alone.columns == corpus_pipeline.run(spark, folder).columns
