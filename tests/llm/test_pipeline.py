"""The pipeline against the same steps done row by row."""

from collections import Counter

import public_tokenizers
from pyspark.sql import functions as F
from test_decontamination import brute as contained
from test_near_dup import brute as components
from test_tokens import check_packing
from tokenizers import Tokenizer

import corpus_pipeline
from aislekit.llm import near_dup, toxicity


def by_hand(rows, labels, items, model):
    """Rows that the filtering stages keep."""
    scored = toxicity.scores([t for _, t in rows], model)
    rows = [r for r, s in zip(rows, scored, strict=True) if s < corpus_pipeline.TOXIC]
    kept = Counter(i for i, n, least, keep in components(rows).elements() if n and keep)
    rows = [r for r in rows if not near_dup.words_of(r[1]) or kept[r[0]]]
    bad = {i for i, _ in contained(rows, items)}
    return [r for r in rows if r[0] not in bad]


def test_stages(spark, sf_dir, documents):
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    docs = documents
    for name, stage in corpus_pipeline.STAGES[:3]:
        before = docs
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == documents.columns, name
        assert docs.join(before, docs.columns, "left_anti").count() == 0
        assert 0 < docs.count() < before.count(), name
    want = by_hand(rows, labels, items, toxicity.train(documents, labels))
    assert Counter((r["doc_id"], r["text"]) for r in docs.collect()) == Counter(want)
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    used, least = check_packing(corpus_pipeline.run(spark, sf_dir).collect(), want, library, 2048)
    assert used <= least + 1


def test_odd_rows_pass_every_stage(spark, sf_dir, make_docs):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "no id"), (4, "a b"), (4, "a b"), (5, "a  b"), (6, "word " * 50_000), (7, "c")]
    docs = make_docs(rows)
    for _, stage in corpus_pipeline.STAGES[:3]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), docs.schema)
    got = Counter((r["doc_id"], r["text"]) for r in docs.collect())
    assert got == Counter([(1, None), (2, ""), (3, " \n"), (None, "no id"), (4, "a b"), (6, "word " * 50_000), (7, "c")])
    assert corpus_pipeline.pack(spark, docs, sf_dir).where(F.col("piece") == 0).count() == 7


def test_contaminated_rows_take_no_other_row_with_them(spark, sf_dir, make_docs):
    item = spark.read.parquet(f"{sf_dir}/benchmark.parquet").first()["text"]
    rows = [(None, f"before {item} after"), (None, "a clean text without id"), (5, item), (5, "a clean text of the same id"), (6, None)]
    got = corpus_pipeline.drop_contaminated(spark, make_docs(rows), sf_dir)
    assert Counter((r["doc_id"], r["text"]) for r in got.collect()) == Counter([rows[1], rows[3], rows[4]])


def test_empty_table_passes_every_stage(spark, sf_dir, make_docs):
    docs = make_docs([])
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, sf_dir)
        assert docs.collect() == []
    assert corpus_pipeline.pack(spark, docs, sf_dir).collect() == []
