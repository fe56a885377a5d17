import public_tokenizers
from llm_cases import ROWS, benchmark_hits, documents, frame, rows, shingle_components
from tokenizers import Tokenizer

import corpus_pipeline
from orderlens.llm import language

FOLDER = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark):
    """Each stage on the rows the one before kept; the network's own verdicts stand for the first."""
    source = spark.read.parquet(f"{FOLDER}/documents.parquet")
    network = language.fit(source, reject=True)
    kept = {r["doc_id"] for r in language.keep_determined(source, network).collect()}
    verdict = {d: d in kept for d, _ in documents()}
    docs = [(d, t) for d, t in documents() if verdict[d]]
    first = {c for _, _, c in shingle_components(docs)}
    docs = [(d, t) for d, t in docs if d in first]
    docs = [(d, t) for (d, t), hit in zip(docs, benchmark_hits(docs, rows("benchmark", "item_id, text")), strict=True) if not hit[2]]
    library = Tokenizer.from_file(public_tokenizers.path(corpus_pipeline.BPE_FILE))
    expected = sorted((d, ids) for d, t in docs for ids in [library.encode(t, add_special_tokens=False).ids])
    got = sorted((r["doc_id"], r["ids"]) for r in corpus_pipeline.run(spark, FOLDER).collect())
    assert got == expected and 0 < len(got) < len(verdict)


def test_odd_rows_and_columns(spark, tmp_path):
    docs = frame(spark, ROWS, ["source", "row_key", "n_tokens", "score"]).selectExpr("*", "'en' lang", "1 n_chars")
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, FOLDER)
        if i < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
    assert docs.columns == ["doc_id", "n_tokens", "ids"] and docs.count() > 3


def test_empty_table(spark):
    empty = spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, FOLDER).collect() == []
