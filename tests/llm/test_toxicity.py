"""Toxicity: kernel against its definition, training on planted insults, odd rows."""

import random
from itertools import combinations

import numpy as np
import pytest

from staylens.llm import toxicity as T

INSULTS = ("moronak", "scumbel", "idiotus")


def brute_kernel(a, b):
    def features(u):
        out = {}
        for i, j, k in combinations(range(len(u)), 3):
            key = u[i] + u[j] + u[k]
            out[key] = out.get(key, 0) + T.DECAY ** (k - i + 1)
        return out

    x, y = features(a), features(b)
    dot = lambda p, q: sum(v * q.get(t, 0) for t, v in p.items())
    return dot(x, y) / np.sqrt(dot(x, x) * dot(y, y))


def test_kernel_matches_its_definition():
    kernel = T.Kernel("abcdefghilmnorst^$")
    for a, b in (("idiot", "idxiot"), ("scum", "scum"), ("aaabbb", "ababab"), ("^moron$", "^moderation$")):
        got = float(kernel.against([a], kernel.dense(b)[:, None])[0, 0])
        assert got == pytest.approx(brute_kernel(a, b), abs=1e-4)


def test_tokens_and_units():
    assert T.unit("i.d*iot!") == "idiot" and "idiot" in T.tokens("You i d i o t there")
    assert T.windows("x" * 3) == ["^xxx$"] and len(T.windows("x" * 100)) > 5


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(2)
    syllables = ["ta", "re", "lon", "vi", "mu", "ster", "ka", "dol", "pen", "i"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(2, 5)))
    rows = []
    for i in range(600):
        text = [word() for _ in range(30)]
        if i % 4 == 0:
            for _ in range(2):
                text.insert(rng.randrange(len(text)), rng.choice(INSULTS))
        rows.append((i, " ".join(text), int(i % 4 == 0)))
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2], None) for r in rows], "doc_id long, toxic int, text string")
    return docs, labels, T.train(T.training_rows(docs, labels))


def test_held_out_documents(spark, trained):
    docs, labels, model = trained
    assert 1 <= sum(any(m.startswith("^" + s[:4]) for s in INSULTS) for m in model.landmarks)
    got = T.score(docs, model).join(labels.drop("text"), T.F.col("id") == T.F.col("doc_id")).where(T.held_out("id")).collect()
    assert len(got) > 80 and np.mean([(r.score >= 0.5) == (r.toxic == 1) for r in got]) > 0.97


def test_gapped_and_inserted_characters(trained):
    _, _, model = trained
    texts = ["talon vimu m o r o n a k kadol", "talon vimu sc-um.bel kadol", "talon vimu idixotus kadol", "talon vimu kadol pentare"]
    worst = model.worst(texts)
    assert min(w[0] for w in worst[:3]) > 0 > worst[3][0]
    assert model.scores(model.worst(["talon vimu scumbel kadol pentare"]))[0] >= 0.5  # one clear insult is enough


def test_odd_rows(spark, trained):
    _, _, model = trained
    rows = [(1, None, "a"), (2, "", "b"), (None, "12 34 !!", "c"), (3, "moronak scumbel " * 2, "d"), (3, "moronak scumbel " * 2, "e"),
            (4, "talon " * 200_000, "f"), (5, "ta" * 100_000, "g")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    got = T.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.id in (1, 2)}) == 1
    kept = T.reject(docs, model)
    assert kept.columns == docs.columns and sorted(r.score for r in kept.collect()) == ["a", "b", "c", "f", "g"]
    assert T.score(docs.limit(0), model).count() == 0
    none = T.train(T.training_rows(docs, spark.createDataFrame([(1, 0), (None, 1), (2, None)], "doc_id long, toxic int")))
    assert {round(r.score, 6) for r in T.score(docs, none).collect()} == {0.0}


HAN = "天地玄黄宇宙洪荒日月盈昃辰宿列张寒来暑往秋收冬藏闰余成岁律吕调阳云腾致雨露结为霜"


def corpus(insert, seed=5, n=800):
    """Documents of made-up words, Cyrillic words and Han stretches; a quarter is toxic."""
    rng = random.Random(seed)
    syllables = ["ta", "re", "lon", "vi", "mu", "ster", "ka", "dol", "pen", "i"]
    slavic = ["ка", "ро", "ви", "ста", "мен", "ло", "ти", "ну"]

    def word():
        kind = rng.random()
        if kind < 0.6:
            return "".join(rng.choice(syllables) for _ in range(rng.randrange(2, 5)))
        if kind < 0.8:
            return "".join(rng.choice(slavic) for _ in range(rng.randrange(2, 4)))
        return "".join(rng.choice(HAN) for _ in range(rng.randrange(8, 25)))

    rows = []
    for i in range(n):
        words = [word() for _ in range(30)]
        insert(rng, words, i % 4 == 0)
        rows.append((i, " ".join(words), int(i % 4 == 0)))
    return rows


def short(rng, words, toxic):
    words.insert(rng.randrange(len(words)), "zub" if toxic else "zubrenka")


def run_together(rng, words, toxic):
    a, b = (rng.choice(["talonvi", "musterka", "dolpen"]) for _ in range(2))
    words.insert(rng.randrange(len(words)), a + ("scumbel" if toxic else "sterlon") + b)


def two_words(rng, words, toxic):
    at = rng.randrange(1, len(words))
    words[at:at] = ["kelm", "tarn"] if toxic else [*(["tarn"] if rng.random() < 0.7 else []), "pendol", *(["kelm"] if rng.random() < 0.7 else [])]


def cyrillic(rng, words, toxic):
    words.insert(rng.randrange(len(words)), rng.choice(["дурак", "дурака", "ду-рак"]) if toxic else "карови")


def han(rng, words, toxic):
    fill = lambda: "".join(rng.choice(HAN) for _ in range(rng.randrange(3, 12)))
    words.insert(rng.randrange(len(words)), fill() + ("混蛋猪头" if toxic else "") + fill())


@pytest.mark.parametrize("insert", [short, run_together, two_words, cyrillic, han])
def test_learns_what_it_scores(spark, insert):
    rows = corpus(insert)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows], "doc_id long, toxic int")
    model = T.train(T.training_rows(docs, labels))
    fresh = corpus(insert, seed=6, n=200)
    got = model.scores(model.worst([r[1] for r in fresh]))
    assert np.mean([(s >= 0.5) == (r[2] == 1) for s, r in zip(got, fresh, strict=True)]) >= 0.95, model.landmarks[:10]


def test_codes_of_letters_beyond_the_alphabet():
    kernel = T.Kernel("abc")
    assert len({int(kernel.code[ord(c)]) for c in HAN}) > 8 and kernel.code[ord("c")] == 2
    assert int(kernel.code[: T.OWN].min()) >= 0 and int(kernel.code[ord("z"):].min()) >= T.OWN


def test_windows_hold_every_stretch():
    u = "".join(chr(ord("a") + i % 26) for i in range(77))
    marked = T.BEGIN + u + T.END
    held = {w[i : i + n] for w in T.windows(u) for n in (4, 9) for i in range(len(w) - n + 1)}
    assert all(marked[i : i + n] in held for n in (4, 9) for i in range(len(marked) - n + 1))
    assert all(len(w) == T.WINDOW for w in T.windows(u))


def test_floor_skips_no_window(trained):
    """Margins with the bound of the norm against margins from norms alone."""
    _, _, model = trained
    rng = random.Random(1)
    units = [T.BEGIN + "".join(rng.choice("moronakscubeltidus") for _ in range(rng.randrange(3, 11))) for _ in range(500)]
    plain = model._kernel.against(units, model.weights[:, None])[:, 0] + model.bias
    assert np.abs(model.margins(units) - np.maximum(plain, T.FLOOR)).max() < 1e-4


def test_pairs_overlap_and_vary():
    pattern = T.pair_pattern(["kelm tarn", "tarn kelm"])
    assert [t for t in T.tokens("Kelm, tarns kelm", pattern) if " " in t] == ["kelm tarns", "tarns kelm"]
    assert T.pair_pattern([]) is None
