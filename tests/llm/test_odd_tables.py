"""Every operator and stage takes odd tables and empty ones, with the results its docstring states."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from cohortix.llm import (bpe, html_extract, jaccard_join, langid, mixing, piece_bpe, quality, sharding, spotsigs,
                          substring, token_align, token_counts)
from cohortix.llm.queries import pieces, vocabulary


@pytest.fixture(scope="session")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (1, 0, 0), (2, 1, None), (None, 1, 0), (3, None, 0)],
                                 "doc_id long, quality int, toxic int")


def learn():
    return F.lit(True)


OPS = {
    "jaccard": lambda df, labels: jaccard_join.jaccard_join(df),
    "bpe": lambda df, labels: bpe.digests(df, vocabulary(), with_ids=True),
    "encode": lambda df, labels: bpe.encode_documents(df, vocabulary()),
    "sharding": lambda df, labels: sharding.interleave(df, 3),
    "quality": lambda df, labels: quality.quality_verdicts(df, labels),
    "mixing": lambda df, labels: mixing.mix(df)[0],
    "substring": lambda df, labels: substring.remove_repeats(df),
    "counts": lambda df, labels: token_counts.count_tokens(df, vocabulary()),
    "langid": lambda df, labels: langid.predict_languages(df, learn()),
    "spotsigs": lambda df, labels: spotsigs.fingerprints(df),
    "align": lambda df, labels: token_align.align_documents(df, vocabulary(), pieces()),
    "pieces": lambda df, labels: piece_bpe.digests(df, pieces()),
    "encode pieces": lambda df, labels: piece_bpe.encode_documents(df, pieces()),
}


@pytest.mark.parametrize("name", OPS)
def test_one_row_per_document(name, odd, none, labels):
    out = OPS[name](odd, labels).collect()
    assert len(out) == odd.count()
    assert sorted(str(r["doc_id"]) for r in out) == sorted(str(r["doc_id"]) for r in odd.collect())
    assert OPS[name](none, labels.limit(0)).collect() == []


def test_pages(spark):
    df = spark.createDataFrame(
        [(1, None, None, 1), (None, "u", "", 1), (2, "u", "<p>a &amp; b</p>" * 3, 1), (2, "u", "<p>a &amp; b</p>" * 3, 1),
         (3, "u", "<p>" + "x " * 60_000, 1)], "page_id long, url string, html string, text int")
    out = {r["page_id"]: r for r in html_extract.extract_text(df).collect()}
    assert out[1]["text"] == "" and out[1]["n_chars"] == 0 and out[None]["text"] == ""
    assert out[2]["text"] == "a & b\n\na & b\n\na & b" and out[3]["n_chars"] == 119_999
    assert html_extract.extract_text(df.limit(0)).collect() == []


@pytest.fixture(scope="session")
def sf_dir(spark, labels, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    labels.write.parquet(f"{d}/labels.parquet")
    return d


@pytest.mark.parametrize("stage", [f for _, f in corpus_pipeline.STAGES], ids=lambda f: f.__name__)
def test_stages(stage, spark, odd, none, sf_dir):
    out = stage(spark, odd, sf_dir)
    rows = out.collect()
    if stage is not corpus_pipeline.token_ids:
        assert {"doc_id", "text", "lang", "source", "n_chars"} <= set(out.columns)
    assert len(rows) <= 2 * odd.count()
    assert stage(spark, none, sf_dir).collect() == []
    ids = [r["doc_id"] for r in rows]
    if stage is corpus_pipeline.near_copies:
        # the copies of document 1 and its near copy 2 leave one, and no other text goes
        assert ids.count(1) == 1 and 2 not in ids and 7 in ids and None in ids
    if stage is corpus_pipeline.quality_rules:
        assert ids == [None]  # 24 words without a repeated window; the others are short or repeat themselves


def test_spans_of_odd_rows(odd):
    out = substring.remove_repeats(odd).collect()
    first = [r for r in out if r["doc_id"] == 1]
    assert [r["n_removed"] for r in first] == [0, 0]  # equal ids leave each other alone
    assert [r["n_removed"] for r in out if r["doc_id"] == 2] == [40]
    null = [r for r in out if r["doc_id"] is None and r["n_words"]]
    assert [r["n_removed"] for r in null] == [20]


def test_languages_of_odd_rows(odd):
    got = {(r["doc_id"], r["lang_pred"]) for r in langid.predict_languages(odd, learn()).collect()}
    assert {(3, "und"), (4, "und"), (5, "und"), (1, "en")} <= got
