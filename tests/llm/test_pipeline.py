import pytest

import corpus_pipeline
from folioscope.llm.jaccard_join import jaccard_join
from folioscope.llm.quality import classify

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, SF).cache()
        out.append(docs)
    return out


def test_all_stages_but_the_last_return_documents(steps):
    assert [s.dtypes for s in steps[:-1]] == [steps[0].dtypes] * len(steps[:-1])
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "line_dedup", "near_duplicates", "mixing", "packing"]


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_quality_keeps_what_the_classifier_keeps(spark, steps):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    assert ids(steps[1]) == ids(classify(steps[0], labels).filter("kept"))
    good = {r.doc_id for r in labels.filter("quality = 1").collect()}
    assert len(good - set(ids(steps[1]))) <= 0.02 * len(good)


def test_lines_change_texts_only(steps):
    assert ids(steps[2]) == ids(steps[1])


def test_one_document_of_each_group(steps):
    assert ids(steps[3]) == ids(jaccard_join(steps[2]).filter("component_id = doc_id"))


def test_mix_takes_words(spark, steps):
    from folioscope.llm.mixing import mix_sources, word_count

    takes = {r.doc_id: r.taken for r in mix_sources(steps[3]).collect()}
    rows = steps[4].select("doc_id", word_count(steps[4]["text"]).alias("n")).groupBy("doc_id").sum("n").collect()
    assert {r[0]: r[1] for r in rows} == {i: t for i, t in takes.items() if t}


def test_packing_holds_every_word(steps):
    from folioscope.llm.mixing import word_count

    assert steps[5].groupBy().sum("n_words").first()[0] == steps[4].select(word_count(steps[4]["text"]).alias("n")).groupBy().sum("n").first()[0]


def test_run_equals_the_stages(spark, steps):
    got = corpus_pipeline.run(spark, SF)
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, steps[5].collect()), key=repr)


def test_edges(spark, documents):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    rows = [(i, f"some plain words about item {i} and nothing else in here", "en", "a") for i in range(40)]
    rows += [(100, None, None, None), (101, "", "en", "a"), (None, "some plain words about nothing", "en", None), (3, rows[3][1], "en", "a")]
    docs = documents(rows)
    import folioscope.llm.stages as stages

    folder = stages.shared_folder(spark) + "/pipeline-edges"
    labels.write.mode("overwrite").parquet(f"{folder}/labels.parquet")
    for _, step in corpus_pipeline.STAGES[:-1]:
        docs = step(spark, docs, folder)
    assert docs.columns == documents([]).columns
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).filter("n_words > 0").count() > 30
    docs = documents([])
    for _, step in corpus_pipeline.STAGES:
        docs = step(spark, docs, folder)
    assert docs.collect() == []


def test_mixed_runs_keep_line_breaks(spark, documents):
    texts = {i: f"  head {i}\n\tindented  twice\r\n" + "\n".join(f"line {j} of\t{i}" for j in range(9 + i)) + " \n" for i in range(12)}
    got = corpus_pipeline.mixed_sources(spark, documents([(i, t, "en", f"s{i % 3}") for i, t in texts.items()]), "").collect()
    parts = 0
    for r in got:
        whole = texts[r.doc_id]
        cuts = [k for k, c in enumerate(r.text) if c == "\n"]
        assert r.text in whole or any(r.text[:k] in whole and r.text[k + 1 :] in whole for k in cuts)
        parts += r.text != whole
    assert parts >= 2


def test_rows_sharing_an_id_with_other_texts_stay(spark, documents):
    rows = [(1, "one text of its own here", "en", "a"), (1, "quite another text under that id", "de", "b"), (1, "one text of its own here", "en", "0"),
            (2, "a third text without any partner at all", "en", "a")]
    got = corpus_pipeline.one_of_each_group(spark, documents(rows), "").collect()
    assert sorted((r.doc_id, r.text, r.source) for r in got) == sorted([(1, rows[2][1], "0"), (1, rows[1][1], "b"), (2, rows[3][1], "a")])
