"""The pipeline against plain versions of its decisions, stage by stage."""

import corpus_pipeline
from mixwright.llm import near_dedup, pii
from mixwright.llm.common import table
from tests.llm.helpers import docs
from tests.llm.test_native_text import plain_statistics


def test_stages_take_effect_and_keep_columns(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    first = now = table(spark, sf, "documents")
    seen = []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, now, sf).write.parquet(str(tmp_path / str(number)))
        now = spark.read.parquet(str(tmp_path / str(number)))
        if number < 4:
            assert sorted(now.dtypes) == sorted(first.dtypes)
        seen.append({r.doc_id: r for r in now.collect()})
    texts = {r.doc_id: r.text for r in first.collect()}
    for i in seen[0]:
        words, *_, repeated = plain_statistics(texts[i])
        assert words >= 50 and 100 * repeated <= 50 * words
    classes = {r.doc_id: r.class_id for r in near_dedup.classes(spark.read.parquet(str(tmp_path / "0"))).collect()}
    assert set(seen[1]) == set(classes.values())
    items = [r.text.lower() for r in table(spark, sf, "benchmark").collect()]
    assert set(seen[2]) == {i for i in seen[1] if not any(t in texts[i].lower() for t in items)}
    assert set(seen[3]) == set(seen[2])
    for i, r in seen[3].items():
        assert not pii.base_spans(r.text) and r.n_chars == len(r.text)
    assert set(seen[4]) <= set(seen[3]) and all(0 < r.taken <= 3 * r.n_words for r in seen[4].values())
    assert {r.doc_id for r in corpus_pipeline.run(spark, sf).collect()} == set(seen[4])


def test_stages_take_odd_tables(spark):
    rows = [(None, None), (1, ""), (2, "word " * 3), (None, "a" * 9), (2, "word " * 3)]
    for odd in (docs(spark, rows), docs(spark, [])):
        for _, stage in corpus_pipeline.STAGES:
            assert stage(spark, odd, "/root/testdata/sf0.001").count() <= odd.count()
