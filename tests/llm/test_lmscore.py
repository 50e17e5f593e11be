"""Cross-entropy difference against a plain implementation; odd rows."""

import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from staylens.llm import lmscore as S

SF = "/root/testdata/sf0.001"


def plain(docs, target, number):
    """docs: (id, text, place, block); the same models with dictionaries."""
    chars = Counter(c for _, t, _, _ in docs for c in t)
    vocab = {c: i + 1 for i, (c, _) in enumerate(sorted(chars.items(), key=lambda p: (-p[1], ord(p[0]))))}
    coded = [[0] * (S.ORDER - 1) + [vocab[c] for c in t] for _, t, _, _ in docs]
    role = {}
    for b in range(number):
        own = [i for i, d in enumerate(docs) if d[3] == b]
        want = 0
        for i in own:
            if docs[i][0] in target:
                role[i] = "t"
                want += len(docs[i][1])
        for i in sorted((i for i in own if i not in role), key=lambda i: (docs[i][2], docs[i][1])):
            if want <= 0:
                break
            role[i] = "b"
            want -= len(docs[i][1])
    models = {}
    for side in "tb":
        c = [Counter() for _ in range(S.ORDER + 1)]
        for i, s in enumerate(coded):
            if role.get(i) == side:
                for e in range(S.ORDER - 1, len(s)):
                    for n in range(1, S.ORDER + 1):
                        c[n][tuple(s[e - n + 1 : e + 1])] += 1
        total, kinds = Counter(), Counter()
        for n in range(1, S.ORDER + 1):
            for g, m in c[n].items():
                total[g[:-1]] += m
                kinds[g[:-1]] += 1
        models[side] = (c, total, kinds)

    def p(side, g):
        c, total, kinds = models[side]
        if len(g) == 1:
            return (c[1][g] + 1) / (total[()] + len(vocab) + 2)
        h, low = g[:-1], p(side, g[1:])
        return (c[len(g)][g] + kinds[h] * low) / (total[h] + kinds[h]) if total[h] else low

    out = []
    for s in coded:
        at = range(S.ORDER - 1, len(s))
        t, b = (sum(-math.log(p(k, tuple(s[e - S.ORDER + 1 : e + 1]))) for e in at) / max(1, len(at)) for k in "tb")
        out.append((len(at), t, b))
    return out


def test_matches_a_plain_implementation(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").where("n_chars < 1500")
    labels = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
    bytes_ = docs.agg(F.sum(F.octet_length("text"))).first()[0]
    number = -(-bytes_ // 20_000)
    assert number > 3
    rows = S.blocks(docs.select(F.col("doc_id").alias("id"), "text").withColumn("place", F.xxhash64(F.lit("background"), "id")), number).collect()
    want = plain([(r.id, r.text, r.place, r.block) for r in rows], {r.doc_id for r in labels.collect()}, number)
    got = {r.id: r for r in S.score(docs, labels, block_bytes=20_000).collect()}
    assert len(got) == len(rows)
    for r, (n, t, b) in zip(rows, want, strict=True):
        g = got[r.id]
        assert g.n_tokens == n and (g.loss_target, g.loss_background, g.score) == pytest.approx((t, b, t - b), abs=1e-6)


def test_target_like_documents_score_lower(spark):
    rows = [(i, ("alpha beta gamma delta " if i % 2 else "zorro quiz waxy jumbo ") * 20 + str(i)) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(i,) for i in range(1, 40, 2)], "doc_id long")
    got = {r.id: r.score for r in S.score(docs, target).collect()}
    assert max(got[i] for i in range(1, 60, 2)) < min(got[i] for i in range(0, 60, 2))


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "some text", "c"), (3, "some other text 字 𐐷", "d"), (3, "some other text 字 𐐷", "e"), (4, "long text " * 60_000, "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, block string")
    target = spark.createDataFrame([(3, 1), (None, 1)], "doc_id long, block int")
    got = S.score(docs, target).collect()
    assert len(got) == len(rows) and all(math.isfinite(r.score) for r in got)
    assert [(r.n_tokens, r.score) for r in got if r.id in (1, 2)] == [(0, 0.0)] * 2
    assert len({r.score for r in got if r.id == 3}) == 1
    assert S.score(docs.limit(0), target).count() == 0
    assert {r.score for r in S.score(docs, target.limit(0)).collect()} == {0.0}


def test_scores_do_not_depend_on_shuffle_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    target = spark.read.parquet(f"{SF}/labels.parquet").where("quality = 1").select("doc_id")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        got = []
        for n in ("2", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            got.append(sorted(map(tuple, S.score(docs, target).collect())))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got[0] == [pytest.approx(r, abs=1e-12) for r in got[1]]


def test_rare_characters_are_spelled(monkeypatch):
    monkeypatch.setattr(S, "VOCABULARY", 2)
    table = S.coder([ord("a"), ord("b")])
    assert S.tokens_of("abz字a🙂", table).tolist() == [1, 2, 3, 3 + S.HIGH_PARTS + 122, 3 + 23383 // 1024, 3 + S.HIGH_PARTS + 23383 % 1024, 1, 3 + 128578 // 1024, 3 + S.HIGH_PARTS + 128578 % 1024]
    assert len({tuple(S.tokens_of(chr(c), table)) for c in range(0x3000, 0x9000)}) == 0x6000


def test_other_scripts_are_scored_by_their_own_characters(spark):
    one, two = "天地玄黃宇宙洪荒日月盈昃", "辰宿列張寒來暑往秋收冬藏"
    filler = [(100 + i, "".join(map(chr, range(0x100 + 20 * i, 0x114 + 20 * i)))) for i in range(20)]  # 400 other characters
    rows = [(i, (one if i % 2 else two) * 15) for i in range(60)] + filler
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    target = spark.createDataFrame([(i,) for i in range(1, 40, 2)], "doc_id long")
    got = {r.id: r.score for r in S.score(docs, target).collect()}
    assert max(got[i] for i in range(1, 60, 2)) < min(got[i] for i in range(0, 60, 2))
