"""The pipeline's stages against plain recomputation, and odd rows through all of them."""

import pytest

import corpus_pipeline as pipeline
from tulha.llm import decontaminate, language, packing, secrets
from tulha.llm.common import table

FOLDER = "/root/testdata/sf0.01"


def test_stages_on_whole_table(spark):
    docs = table(spark, FOLDER, "documents")
    before = {r.doc_id: r.text for r in docs.collect()}
    sizes = {}
    for name, stage in pipeline.STAGES:
        docs = pipeline.stored(stage(spark, docs, FOLDER), name)
        sizes[name] = docs.count()
        if name == "language":
            model = language.train(table(spark, FOLDER, "documents"))
            ids = list(before)
            rejected = model.predict([before[i] for i in ids])[2]
            want = {i for i, r in zip(ids, rejected) if not r}
            assert {r.doc_id for r in docs.collect()} == want and len(want) > 980
        if name == "near_duplicates":
            assert sizes[name] < sizes["language"]
            assert len({r.text for r in docs.collect()}) == sizes[name]
        if name == "decontamination":
            items = [decontaminate.plain(r.text) for r in table(spark, FOLDER, "benchmark").collect()]
            left = {r.doc_id: r.text for r in docs.collect()}
            assert sizes[name] < sizes["near_duplicates"]
            assert not any(i in decontaminate.plain(t) for t in left.values() for i in items)
        if name == "secrets":
            assert sizes[name] == sizes["decontamination"] and docs.columns == list(pipeline.table(spark, FOLDER, "documents").columns)
            found = secrets.base_spans(docs).where("size(_base) > 0").count()
            assert found == 0 and docs.where("text like '%[secret]%'").count() > 0
            assert docs.where("n_chars <> length(text)").count() == 0
            texts = {r.doc_id: r.text for r in docs.collect()}
    rows = docs.collect()
    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_sequence.setdefault(r.sequence_id, []).append(r)
    assert by_doc.keys() == texts.keys()
    for i, text in texts.items():
        ids = packing.encode(text) + packing.CLOSING
        assert sum(r.length for r in by_doc[i]) == len(ids) // 4
    for parts in by_sequence.values():
        at = 0
        for r in sorted(parts, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= packing.LENGTH


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, _key string"


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows(spark, empty):
    say = "the house and the garden of the old man were near the river %s"
    rows = [(1, None, "en", None, None, "a"), (2, "", "en", "s", 0, "b"), (3, say % "x", "en", "s", 9, "c")]
    rows += [(3, say % "x", "en", "s", 9, "c"), (4, say % "x", None, "s", 9, "d"), (None, say % "x", "en", "s", 9, "e")]
    rows += [(None, " ".join((say % "x").split()[::-1]), "en", "s", 9, "f"), (7, "!!! 123", "en", "s", 1, "g")]
    docs = spark.createDataFrame([] if empty else rows, SCHEMA)
    for name, stage in pipeline.STAGES:
        docs = pipeline.stored(stage(spark, docs, "/root/testdata/sf0.001"), name)
        if name == "near_duplicates" and not empty:
            got = [(r.doc_id, r._key) for r in docs.collect()]
            assert sorted(map(str, got)) == ["(3, 'c')", "(None, 'f')"]
    assert docs.count() == (0 if empty else 2)
