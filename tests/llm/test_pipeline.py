from collections import Counter

import corpus_pipeline
from marketlake.llm import quality, toxicity

from .test_neardup import brute_force
from .test_packing import check_rows

SF = "/root/testdata/sf0.001"


def test_stages_like_brute_force(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality", "toxicity", "near_duplicates", "pii", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        before = {r.doc_id: r for r in docs.collect()}
        out = stage(spark, docs, SF)
        if name == "packing":
            check_rows(out.collect(), [(d, r.text) for d, r in before.items()])
            break
        assert out.columns == columns
        out.write.mode("overwrite").parquet(path := f"{spark.conf.get('spark.sql.warehouse.dir')}/stage-{name}")
        docs = spark.read.parquet(path)
        after = {r.doc_id: r for r in docs.collect()}
        gone = before.keys() - after.keys()
        if name == "quality":
            assert sum(bool(labels[d].quality) for d in gone if d in labels) <= 3 and len(gone) > 5
        elif name == "toxicity":
            assert sum(not labels[d].toxic for d in gone if d in labels) <= 2
        elif name == "near_duplicates":
            kept = {d for d, _, _, k in brute_force([(d, r.text) for d, r in before.items()], 5, 80) if k}
            assert set(after) == kept
        else:
            assert not gone
            for d, r in before.items():
                assert len(after[d].text) == after[d].n_chars
                assert (after[d].text != r.text) == ("@" in r.text or after[d].text != r.text)
    assert Counter(labels)  # the labels were read


def test_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 50
    assert callable(quality.fit) and callable(toxicity.fit)
