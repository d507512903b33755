import corpus_pipeline
from rollbook.llm.exact_dedup import exact_duplicates
from rollbook.llm.near_dedup import near_duplicates
from rollbook.llm.queries import REGISTRY
from rollbook.llm.quality_classifier import classify
from rollbook.llm.quality_rules import apply_rules
from rollbook.llm.sql import STATEMENTS


def test_pipeline_stages(spark, docs, labels, tmp_path):
    """Each stage keeps what its operator keeps of its input, all columns as they are."""
    folder = str(tmp_path)
    labels.write.parquet(f"{folder}/labels.parquet")
    docs.write.parquet(f"{folder}/documents.parquet")
    now = spark.read.parquet(f"{folder}/documents.parquet")
    judges = [
        lambda d: classify(d),
        lambda d: apply_rules(spark, d, labels),
        lambda d: exact_duplicates(spark, d),
        lambda d: near_duplicates(spark, d),
    ]
    for number, ((_, apply), judge) in enumerate(zip(corpus_pipeline.STAGES[:-1], judges)):
        after = apply(spark, now, folder)
        assert after.columns == docs.columns
        after.write.parquet(f"{folder}/{number}")
        after = spark.read.parquet(f"{folder}/{number}")
        kept = {r["doc_id"] for r in judge(now).filter("kept").collect()}
        assert {r["doc_id"] for r in after.collect()} == kept
        now = after
    packed = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in packed.collect()} == {r["doc_id"] for r in now.collect()}


def test_names():
    assert sorted(int(name[2:].split("_")[0]) for name in REGISTRY) == list(range(1, 14))
    assert set(STATEMENTS) <= set(REGISTRY)
