"""Fill-in-middle: boundary containers, cuts, forms, exact restoration, odd rows."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from staylens.llm import fim as M
from staylens.llm.queries import QUERIES

UNIT = re.compile("[\x20\x09-\x0d]*[^\x20\x09-\x0d]+|[\x20\x09-\x0d]+")


def by_definition(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    n = len(units)
    hexed = hashlib.sha256(f"42:{doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(hexed[8 * i : 8 * i + 8], 16) for i in range(4))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return n, "plain", None, None, text
    pre, mid, suf = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h4 % 100 < 80:
        return n, "spm", len(pre), len(mid), f"<S>{suf}<P>{pre}<M>{mid}"
    return n, "psm", len(pre), len(mid), f"<P>{pre}<S>{suf}<M>{mid}"


@pytest.mark.parametrize("kind", ["array", "bitmap", "run"])
def test_containers_select_every_rank(kind):
    rng = np.random.default_rng(1)
    low = {
        "array": np.sort(rng.choice(65536, 500, replace=False)),
        "bitmap": np.sort(rng.choice(65536, 30000, replace=False)),
        "run": np.concatenate((np.arange(10, 5000), np.arange(6000, 65536))),
    }[kind]
    found = M.BoundarySet()
    found.append(3, low)
    found.append(7, np.array([0, 65535]))
    assert found.containers[0][0] == kind
    want = [3 * 65536 + int(x) for x in low] + [7 * 65536, 7 * 65536 + 65535]
    assert len(found) == len(want)
    ranks = range(len(want)) if kind == "array" else [0, 1, len(low) // 2, len(low) - 1, len(low), len(low) + 1]
    assert [found.select(r) for r in ranks] == [want[r] for r in ranks]
    for bad in (-1, len(want)):
        with pytest.raises(IndexError):
            found.select(bad)


def test_boundaries_are_the_ends_of_the_units():
    rng = random.Random(5)
    texts = ["", " ", "a", "a ", " a", "\t\n a\x0bb \r\n", "a\x1cb\xa0c 字🙂 x"]
    texts += ["".join(rng.choice("ab \t字🙂\xa0") for _ in range(rng.randrange(60))) for _ in range(300)]
    texts += ["x " * 40000 + " ", " " * 65535 + "a b", "a" * 65536 + " b", "a" * 65535 + " b", " " * 70000]
    for text in texts:
        ends = np.cumsum([len(u) for u in UNIT.findall(text)]).tolist()
        found = M.boundaries(text)
        ranks = range(len(ends)) if len(ends) < 100 else [0, 1, 17, len(ends) // 2, len(ends) - 1]
        assert len(found) == len(ends)
        assert [found.select(r) + 1 for r in ranks] == [ends[r] for r in ranks]
    chars = M.boundaries("字" * 70000, "chars")
    assert len(chars) == 70000 and chars.containers[0][0] == "run" and chars.select(66000) == 66000


def test_documents_against_the_definition(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in QUERIES["op11_fill_in_middle"](spark, sf).collect()}
    docs = spark.read.parquet(f"{sf}/documents.parquet").collect()
    assert len(got) == len(docs)
    forms = set()
    for d in docs:
        n, form, pre, mid, out = by_definition(d.doc_id, d.text)
        r = got[d.doc_id]
        forms.add(form)
        assert (r.n, r.form, r.prefix_chars, r.middle_chars) == (n, form, pre, mid)
        assert r.output_sha256 == hashlib.sha256(out.encode()).hexdigest()
        assert r.restored_sha256 == hashlib.sha256((d.text or "").encode()).hexdigest()
    assert forms == {"plain", "spm", "psm"}


def test_odd_rows(spark):
    texts = [None, "", " ", "\n\n", "a", "<", "<P", "<S", "x <P> y", "<<S>", "a>b<", "P> S> M>", "<P<S<M", "字 🙂 é\x0b\x0c",
             "a\x00b c", "w " * 200000, "word"]
    rows = [(i, t) for i, t in enumerate(texts * 12)] + [(None, "one two three"), (7, "twice"), (7, "twice")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"id": F.lit("x"), "n": F.lit(1), "form": F.lit("psm")})
    got = M.fill_in_middle(docs).select("*", M.restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert len(got) == len(rows)
    key = lambda r: (r[0] is None, r[0] or 0, r[1] or "")
    back = sorted(((r.id, r.back) for r in got), key=key)
    assert back == sorted(((i, t or "") for i, t in rows), key=key)
    for r in got:
        if r.id is not None:
            assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output) == by_definition(r.id, r.back)
    assert M.fill_in_middle(docs.limit(0)).count() == 0


def test_char_units_and_rates(spark):
    docs = spark.createDataFrame([(i, "abc def " * 5) for i in range(50)], "doc_id long, text string")
    got = M.fill_in_middle(docs, unit="chars", plain_from=100, spm_below=0).collect()
    assert {r.form for r in got} == {"psm"} and {r.n for r in got} == {40}
    assert len({(r.prefix_chars, r.middle_chars) for r in got}) > 25
