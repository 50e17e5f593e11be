"""Language ID: n-grams and vectors by definition, held-out accuracy, odd rows."""

import numpy as np
from pyspark.sql import functions as F

from staylens.llm import langid as G

SF = "/root/testdata/sf0.01"


def plain_grams(text, n=3):
    words = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else " " for c in text).split()
    s = " " + " ".join(words) + " " if words else " "
    out = {}
    for i in range(len(s) - n + 1):
        out[s[i : i + n]] = out.get(s[i : i + n], 0) + 1
    return out


def decoded(text):
    codes, counts = G.grams(text)
    return {"".join(chr(c >> k & 0x1FFFFF) for k in (42, 21, 0)): int(m) for c, m in zip(codes.tolist(), counts, strict=True)}


def test_grams_by_definition(monkeypatch):
    texts = ["Été, l'été!  ok", "", "a", "1 2", "x " * 50, "ßß straße 字字 𐐷x", "ab\ncd\tE"]
    for t in texts:
        assert decoded(t) == plain_grams(t), t
    whole = decoded(" ".join(texts) * 9)
    monkeypatch.setattr(G, "CHARS", 7)
    assert decoded(" ".join(texts) * 9) == whole


def test_bundle_by_definition():
    space = G.Space(dim=64)
    codes, counts = G.grams("abc abd")
    want = np.zeros(64)
    for c, m in zip(codes.tolist(), counts, strict=True):
        a, b, d = (space.letter(c >> k & 0x1FFFFF).astype(int) for k in (42, 21, 0))
        want += m * np.roll(a, 2) * np.roll(b, 1) * d
    assert (space.bundles([(codes, counts)])[0] == want).all()


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    languages = G.prototypes(G.training_rows(docs))
    got = G.identify(docs, languages).join(docs.select("doc_id", "lang"), F.col("id") == F.col("doc_id")).where(G.held_out("id")).collect()
    assert len(got) > 250 and np.mean([r.lang == r.lang_pred for r in got]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows(spark):
    rows = [(i, f"alpha beta gamma delta {'abcdefghij'[i % 10]}", "xx", 1) for i in range(12)]
    rows += [(20 + i, f"zorro zubat quizz quaxx {'abcdefghij'[i % 10]}", "yy", 1) for i in range(12)]
    rows += [(40, None, "xx", 1), (41, "", None, 1), (42, "12 ?!", "yy", 1), (None, "zorro quaxx", None, 1), (43, "alpha " * 200_000, None, 1), (43, "alpha " * 200_000, None, 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score int")
    languages = G.prototypes(G.training_rows(docs))
    assert languages[0] == ["xx", "yy"]
    got = [(r.id, r.lang_pred) for r in G.identify(docs, languages).collect()]
    assert len(got) == len(rows)
    assert dict(got[24:])[40] == dict(got[24:])[41] == dict(got[24:])[42] == "und"
    assert dict(got)[None] == "yy" and [p for i, p in got if i == 43] == ["xx", "xx"]
    none = G.prototypes(G.training_rows(docs.limit(0)))
    assert {r.lang_pred for r in G.identify(docs, none).collect()} == {"und"}
    assert G.identify(docs.limit(0), languages).count() == 0


def test_letters_beyond_the_bmp():
    assert len(G.grams("🙂🎉 123 𝟙𝟚𝟛 ²")[0]) == 0  # emoji, digits, mathematical digits
    assert len(G.grams("𐐀𐐁𐐂")[0]) > 0
    assert G.grams("𐐀𐐁")[0].tolist() == G.grams("𐐨𐐩")[0].tolist()  # upper and lower case
    assert G.grams("a🙂b")[0].tolist() == G.grams("a b")[0].tolist()


def test_texts_without_letters_are_undetermined(spark):
    docs = spark.createDataFrame([(0, "der die das und", "de"), (2, "the and of", "en"), (5, "🙂🎉", None), (6, "𝟙𝟚𝟛 42", None)], "doc_id long, text string, lang string")
    found = {r.id: r.lang_pred for r in G.identify(docs, G.prototypes(G.training_rows(docs))).collect()}
    assert found[5] == found[6] == "und"
