"""Benchmark decontamination: verbatim, re-parameterised, slot consistency, brute force."""

import re

from staylens.llm import decontaminate as D
from staylens.llm.words import Words

SF = "/root/testdata/sf0.001"
QUESTION = (
    "Yesterday the farmer called Alice bought 12 apples and 30 pears, then Alice gave 5 kg of the apples to "
    "her neighbour Bob for 7 dollars; how many apples were left when Bob came back with 12 boxes?"
)


def clean_words(text):
    return [w.lower() for w in re.findall(r"[^\W_]+(?:(?<=\d)[.,](?=\d)[^\W_]+)*", text)]


def test_words_match_a_regular_expression():
    texts = ["It's 3.50 or 1,000 - no 4.x, Été ÀB..9 ß", "", "second text here", " 5,6. 7 "]
    w = Words(texts)
    for i, t in enumerate(texts):
        mine = [t[s:e].lower() for s, e, d in zip(w.start, w.end, w.doc, strict=True) if d == i]
        assert mine == clean_words(t)
    a = Words(["Word word WORD other"])
    assert len(set(a.hash.tolist())) == 2 and a.capital.tolist() == [True, False, True, False]
    assert Words(["One two. Three\nfour: five"]).opens.tolist() == [True, False, True, True, True]


def test_reparameterised_question_is_caught():
    index = D.ItemIndex([QUESTION, "An item without any relation to the other one at all, only words."])
    other = QUESTION.replace("Alice", "Carol").replace("Bob", "Dan").replace("12", "14").replace("30", "9,5").replace("5 kg", "8 lbs")
    mixed = QUESTION.replace("bought 12", "bought 14").replace("Alice gave", "Carol gave").replace("Bob came", "Alice came")
    filler = "some words before it. "
    got = {r[0]: r for r in D.matches(index, [filler + QUESTION, filler * 3 + other + filler, filler * 9])}
    assert set(got) == {0, 1} and got[1][1] == 0 and got[1][4] > 3
    d, _, met, windows, _, start, end = got[0]
    assert met == windows and (filler + QUESTION)[start:end] == QUESTION[:-1]
    # inconsistent slots cover fewer windows than consistent ones
    plain = D.matches(index, [mixed], similarity=0.0)
    assert plain[0][2] < windows


def test_scattered_windows_do_not_count():
    words = QUESTION.split()
    scattered = " ".join(" ".join(words[i : i + 7]) + " unrelated" * 60 for i in range(0, len(words), 2))
    assert not D.matches(D.ItemIndex([QUESTION]), [scattered])


def test_documents_against_brute_force(spark):
    docs, bench = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/benchmark.parquet")
    items = {b.item_id: clean_words(b.text) for b in bench.collect()}
    want = set()
    for d in docs.collect():
        text = f" {' '.join(clean_words(d.text))} "
        want |= {(d.doc_id, i) for i, w in items.items() if f" {' '.join(w)} " in text}
    rows = D.contaminated(docs, bench, block_bytes=2000).collect()  # several blocks
    got = {(r.id, r.item_id) for r in rows}
    assert want <= got and want and len(got) <= len(want) * 1.2 + 2
    assert {(r.id, r.item_id) for r in D.contaminated(docs, bench).collect()} == got
    kept = D.decontaminate(docs, bench)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {r.doc_id for r in docs.collect()} - {d for d, _ in got}


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "b"), (None, "x " + QUESTION, "c"), (3, QUESTION, "d"), (3, QUESTION, "d"),
            (4, "long " * 300_000 + QUESTION, "e"), (5, "Tiny item", "f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id string")
    bench = spark.createDataFrame([(7, QUESTION, 1), (7, QUESTION, 1), (None, "tiny item!", 2), (8, None, 3), (9, "...", 4)], "item_id long, text string, row int")
    got = sorted((r.id or 0, r.item_id or 0) for r in D.contaminated(docs, bench).collect())
    assert got == [(0, 7), (0, 7), (3, 7), (3, 7), (3, 7), (3, 7), (4, 7), (4, 7), (5, 0)]
    assert sorted(r.doc_id for r in D.decontaminate(docs, bench).collect()) == [1, 2]
    assert D.contaminated(docs.limit(0), bench).count() == 0 and D.contaminated(docs, bench.limit(0)).count() == 0


def test_two_copies_of_a_template_are_read_by_themselves():
    item = "Alice bought 12 apples and 30 pears while Bob sold 7 plums to Carol for 9 dollars"
    other = "Maria bought 15 apples and 44 pears while Peter sold 8 plums to Susan for 6 dollars"
    third = "Laura bought 21 apples and 55 pears while Frank sold 3 plums to Diana for 2 dollars"
    index = D.ItemIndex(["once " + item])
    windows = int(index.count[0])
    filler = " ".join(f"filler{c}" for c in "abcdefgh") + " so "
    for first, second in ((item, other), (other, item), (other, third)):
        for gap in (filler * 40, filler, ""):
            got = D.matches(index, ["once " + first + ". " + gap + "Now once " + second + "."])
            assert [r[2] for r in got] == [windows], (first, second, len(gap))
    # many copies, none of them whole: values of one copy do not help another
    half = " ".join(item.split()[:9])
    assert not D.matches(index, [" ".join("once " + half.replace("12", str(n)) + ". " + filler * 5 for n in range(20, 60))])


def test_opening_names_case_and_line_breaks():
    tom = "Tom has 5 apples. Tom buys 3 more. Ann takes 2. How many apples does Tom have?"
    index = D.ItemIndex([tom, QUESTION])
    full = [int(n) for n in index.count]

    def met(text):
        return {r[1]: r[2] for r in D.matches(index, ["Some words. " + text + "\nmore words"])}

    assert met(tom) == {0: full[0]} and met(QUESTION) == {1: full[1]}
    renamed = tom.replace("Tom", "Peter").replace("Ann", "Maria")
    assert met(renamed) == {0: full[0]}
    assert met(renamed.replace("5", "8").replace("3", "12")) == {0: full[0]}
    for item, text in enumerate((tom, QUESTION)):
        for form in (text.lower(), text.upper(), text.replace(" ", "\n"), text.title()):
            assert met(form) == {item: full[item]}, form
    other = QUESTION.replace("Alice", "Carol").replace("Bob", "Dan")
    for name in ("Carol", "Dan"):
        assert met(other.replace(f" {name}", f"\n{name}")) == {1: full[1]}
    for form in (QUESTION.lower(), QUESTION.upper()):
        assert met(form.replace("12", "14").replace("30", "44")) == {1: full[1]}
    # one name for two people is no re-parameterisation
    assert 0 not in met(tom.replace("Ann", "Tom").replace("Tom buys", "Ann buys"))


def test_single_window_items_keep_their_opening_word():
    index = D.ItemIndex(["Define gross margin", "Explain how rain is made"])
    assert not D.matches(index, ["The gross margin. Tells how rain is made"])
    assert len(D.matches(index, ["define Gross MARGIN, explain how\nRain is made"])) == 2
