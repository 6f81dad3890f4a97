"""Each pipeline stage, on its own input, against plain Python or the SQL of its operator."""

import hashlib
import math

import duckdb
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from cohortix.llm import queries, twins

from .conftest import SF
from .test_pairs import WORD, brute_removed


def sql(query, folder):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{folder}/*.parquet')")
    con.execute(f"CREATE VIEW labels AS SELECT * FROM read_parquet('{SF}/labels.parquet')")
    cur = con.execute(query)
    names = [d[0] for d in cur.description]
    return [dict(zip(names, r)) for r in cur.fetchall()]


@pytest.fixture(scope="module")
def tables(spark, docs, tmp_path_factory):
    """Folder of the input and of each stage's output, as the driver writes and rereads them."""
    top = tmp_path_factory.mktemp("stages")
    out = [f"{top}/in"]
    docs.write.parquet(out[0])
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out.append(f"{top}/{i}")
        stage(spark, spark.read.parquet(out[-2]), SF).write.parquet(out[-1])
    return out


def rows(spark, folder):
    return spark.read.parquet(folder).collect()


def test_order_and_columns(spark, tables):
    assert [f.__name__ for _, f in corpus_pipeline.STAGES] == [
        "quality_rules", "near_copies", "repeated_passages", "source_mix", "token_ids"]
    for folder in tables[:-1]:
        assert spark.read.parquet(folder).columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality_keeps_what_sql_keeps(spark, tables):
    want = sorted(r["doc_id"] for r in sql(twins.OP4, tables[0]) if r["kept"])
    assert sorted(r["doc_id"] for r in rows(spark, tables[1])) == want
    assert 0 < len(want) < len(rows(spark, tables[0]))


def test_one_of_each_class_stays(spark, tables):
    classes = sql(twins.OP1, tables[1])
    assert sorted(r["doc_id"] for r in rows(spark, tables[2])) == sorted({r["class_id"] for r in classes})
    assert any(r["n_links"] for r in classes)
    left = sql(twins.OP1, tables[2])
    assert all(r["class_id"] == r["doc_id"] and r["n_links"] == 0 for r in left)


def test_repeated_words_go(spark, tables):
    before = {r["doc_id"]: r for r in rows(spark, tables[2])}
    want = brute_removed([(i, r["text"]) for i, r in before.items()])
    after = {r["doc_id"]: r for r in rows(spark, tables[3])}
    for i, (n, gone, sha) in want.items():
        if gone == n and n:
            assert i not in after
        elif gone:
            assert hashlib.sha256(after[i]["text"].encode()).hexdigest() == sha
            assert after[i]["n_chars"] == len(after[i]["text"])
        else:
            assert after[i]["text"] == (before[i]["text"] or "")
    assert any(gone for _, gone, _ in want.values())


def test_mix_repeats_documents(spark, tables):
    want = {r["doc_id"]: math.ceil(r["taken"] / r["size"]) if r["size"] else 0 for r in sql(twins.OP6, tables[3])}
    got = {}
    texts = {r["doc_id"]: tuple(r) for r in rows(spark, tables[3])}
    for r in rows(spark, tables[4]):
        got[r["doc_id"]] = got.get(r["doc_id"], 0) + 1
        assert tuple(r) == texts[r["doc_id"]]
    assert got == {i: n for i, n in want.items() if n}
    words = sum(len(WORD.findall(t[1])) for t in texts.values())
    assert sum(len(WORD.findall(texts[i][1])) * n for i, n in got.items()) == pytest.approx(1.5 * words, rel=0.2)


def test_tokens_are_the_library_s(spark, tables):
    library = Tokenizer.from_file(queries.vocabulary())
    texts = {r["doc_id"]: r["text"] for r in rows(spark, tables[4])}
    out = rows(spark, tables[5])
    assert len(out) == len(rows(spark, tables[4]))
    for r in out:
        ids = library.encode(texts[r["doc_id"]], add_special_tokens=False).ids
        assert list(r["ids"]) == ids and r["n_tokens"] == len(ids)
        assert r["decoded_sha256"] == hashlib.sha256(texts[r["doc_id"]].encode()).hexdigest()


def test_run_equals_the_stages(spark, tables):
    key = lambda x: sorted((r["doc_id"], r["ids_sha256"], r["source"]) for r in x)
    assert key(corpus_pipeline.run(spark, SF).collect()) == key(rows(spark, tables[5]))
