"""The pipeline stage by stage on sf0.001, each against a plain version of its rule."""

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline as C
from staylens.llm.common import store

from .test_decontaminate import clean_words
from .test_pack import check
from .test_simhash import brute_components, brute_fp

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs = [spark.read.parquet(f"{SF}/documents.parquet")]
    for name, stage in C.STAGES:
        docs.append(store(stage(spark, docs[-1], SF), name))
    return docs


def rows(df):
    return sorted(df.collect(), key=lambda r: r.doc_id)


def test_columns(steps):
    assert len(C.STAGES) in (4, 5)
    for df in steps[1:-1]:
        assert df.columns == steps[0].columns and df.dtypes == steps[0].dtypes


def test_toxicity_only_removes(steps):
    before, after = rows(steps[0]), rows(steps[1])
    assert set(after) <= set(before) and len(after) > 0.5 * len(before)


def test_line_dedup_keeps_every_line_once(steps):
    before, after = rows(steps[1]), rows(steps[2])
    lines = lambda d: {line for r in d for line in r.text.split("\n") if len(line.split()) >= 10}
    masked = len(lines(before)) - len(lines(after))
    assert lines(after) <= lines(before) and masked <= 0.2 * len(lines(before))
    seen = [line for r in after for line in set(r.text.split("\n")) if len(line.split()) >= 10]
    assert len(seen) == len(set(seen))
    assert all(r.n_chars == len(r.text) for r in after)


def test_one_document_of_each_group_stays(steps):
    before, after = rows(steps[2]), rows(steps[3])
    group = brute_components([brute_fp(r.text) for r in before])
    assert [r.doc_id for r in after] == [before[i].doc_id for i in sorted(set(group))]


def test_contaminated_documents_go(spark, steps):
    before, after = rows(steps[3]), rows(steps[4])
    items = [f" {' '.join(clean_words(b.text))} " for b in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    kept = {r.doc_id for r in after}
    for r in before:
        text = f" {' '.join(clean_words(r.text))} "
        if any(i in text for i in items):
            assert r.doc_id not in kept
    assert len(kept) >= 0.7 * len(before)


def test_every_token_is_packed(steps):
    t = Tokenizer.from_file(public_tokenizers.path(C.TOKENIZER))
    docs, pieces = rows(steps[4]), steps[5].collect()
    assert check(pieces, 2048) <= sum(r.length for r in pieces) / 2048 * 1.05 + 1
    for r in docs:
        assert sum(p.length for p in pieces if p.doc_id == r.doc_id) == len(t.encode(r.text).ids) + 1


def test_odd_rows(spark, tmp_path):
    docs = [(None, None, None, None, None), (1, "", "en", None, 0), (1, "", "en", None, 0), (2, "a b c " * 40_000, None, "s", 1)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    for name, data in (("some", docs), ("none", [])):
        d = f"{tmp_path}/{name}"
        spark.createDataFrame(data, schema + ", row string" if not data else schema).write.parquet(f"{d}/documents.parquet")
        spark.createDataFrame([(2, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
        spark.createDataFrame([(None, None)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
        got = C.run(spark, d).collect()
        assert (len(got) > 0) == bool(data)
