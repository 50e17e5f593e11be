"""Packing: token ids, cutting, gapless placement, number of sequences."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from staylens.llm import pack as P

PATH = public_tokenizers.path("byte_bpe_50k.json")
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def reference():
    t = Tokenizer.from_file(PATH)
    return lambda text: t.encode(text, add_special_tokens=False).ids


def test_ids_are_those_of_tokenizers(reference):
    rng = random.Random(3)
    alphabet = "aZé ñ0٣²½ª\t\n\r  ​́字🙂'ßİ<|endoftext|>'s're.,!_-%$€”–" + "".join(map(chr, range(0x80, 0x250)))
    encode = P.encoder(PATH)
    for _ in range(3000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
        assert encode(text) == reference(text), repr(text)
    assert encode("hello <|endoftext|> world") == [31373, 220, 50256, 995]
    for text in ("<|endoftext|>", "<|endoftext", "a<|endoftext|><|endoftext|> b", "字<|endoftext|>字", "it's  fine \n\n then", "a" * 3000, " " * 3000 + "x"):
        assert encode(text) == reference(text)


def test_cuts():
    assert P.cuts(5, 4) == [(0, 1), (1, 4)]
    assert P.cuts(8, 4) == [(0, 4), (4, 4)]
    assert P.cuts(3, 4) == [(0, 3)]


def check(rows, size):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= size
    return len(by)


def test_documents(spark, reference):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = P.pack_documents(docs, PATH).collect()
    want = set()
    total = 0
    for d in docs.collect():
        ids = np.array([*reference(d.text), 0], "<u4")
        total += len(ids)
        want |= {(d.doc_id, i, s, n, zlib.crc32(ids[s : s + n].tobytes())) for i, (s, n) in enumerate(P.cuts(len(ids), 2048))}
    assert {(r.id, r.piece, r.start, r.length, r.ids_crc32) for r in rows} == want and len(rows) == len(want)
    assert check(rows, 2048) <= -(-total // 2048) * 1.02 + 1


def test_compositions_use_every_piece_once():
    rng = random.Random(5)
    for size in (7, 32, 64):
        for _ in range(60):
            counts = {n: rng.randrange(1, 30) for n in rng.sample(range(1, size + 1), rng.randrange(1, size))}
            used = {}
            plan = P.compositions(counts, size)
            for parts, n in plan:
                assert 0 < sum(parts) <= size and n > 0
                for p in parts:
                    used[p] = used.get(p, 0) + n
            assert used == counts
            # never more than plain best-fit decreasing plus one sequence
            plain = sum(n for _, n in P._best_fit(counts, size))
            assert sum(n for _, n in plan) <= plain * 1.05 + 1


def test_exact_complements_are_found():
    assert sorted(P.compositions({5: 2, 3: 2}, 8)) == [((5, 3), 2)]
    assert P.compositions({6: 1, 1: 2}, 8) == [((6, 1, 1), 1)]
    assert P.compositions({10: 2, 3: 2, 2: 4}, 17) == [((10, 3, 2, 2), 2)]


def test_odd_rows(spark):
    rows = [(1, None, "a"), (1, None, "a"), (None, "", "b"), (2, "some words here " * 3000, "c"), (3, "x", "d")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, length string")
    got = P.pack_documents(docs, PATH, size=64, with_ids=True).collect()
    assert sorted((r.id is None, r.id or 0, r.length) for r in got if r.id != 2) == [(False, 1, 1), (False, 1, 1), (False, 3, 2), (True, 0, 1)]
    assert sum(r.length for r in got if r.id == 2) == sum(len(r.ids) for r in got if r.id == 2)
    check(got, 64)
    assert P.pack_documents(docs.limit(0), PATH).count() == 0
