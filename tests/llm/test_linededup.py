"""Line dedup: templates, first occurrence kept, odd rows (values: SQL in test_sql)."""

from staylens.llm import linededup as L

LONG = "this passage of more than ten words stands in several documents of the corpus today"


def run(spark, rows, extra=""):
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars long, row string")
    return docs, {(r.row.doc_id, r.row.lang): (r.text, r.n_lines, r.n_dropped) for r in L.drop_repeated_lines(docs).collect()}


def test_first_occurrence_stays(spark):
    rows = [(i, f"own line number {'abcde'[i]} stands here\n{LONG}\nthe end {'vwxyz'[i]}", "en", 1, "r") for i in range(5)]
    _, got = run(spark, rows)
    assert got[0, "en"] == (rows[0][1], 3, 0)
    for i in range(1, 5):
        assert got[i, "en"] == (f"own line number {'abcde'[i]} stands here\nthe end {'vwxyz'[i]}", 3, 1)


def test_variable_fields_generalise(spark):
    a = LONG.replace("several", "many")
    b = LONG.replace("corpus", "collection").replace("documents", "documents99")
    _, got = run(spark, [(1, LONG, "x", 1, ""), (2, a, "x", 1, ""), (3, f"order 17 of item 4 was shipped to town today yes {LONG}", "x", 1, ""),
                         (4, f"order 99 of item 8 was shipped to town today yes {LONG}", "x", 1, ""), (5, b, "x", 1, "")])
    assert got[2, "x"] == ("", 1, 1)  # one replaced word
    assert got[3, "x"][2] == 0 and got[4, "x"][2] == 1  # numbers are fields
    assert got[5, "x"][2] in (0, 1)


def test_other_leaf_stays(spark):
    _, got = run(spark, [(1, LONG, "x", 1, ""), (2, "But " + LONG, "x", 1, ""), (3, " ".join(reversed(LONG.split())), "x", 1, "")])
    assert all(v[2] == 0 for v in got.values())


def test_short_lines_need_more_documents(spark):
    rows = [(i, f"All rights reserved.\n{'abcdefghijklm'[i]} only here in this document, long enough", "x", 1, "") for i in range(12)]
    _, few = run(spark, rows[:9])
    assert all(v[2] == 0 for v in few.values())
    _, many = run(spark, rows)
    assert sum(v[2] for v in many.values()) == 11


def test_odd_rows(spark):
    rows = [
        (1, None, "a", None, "r"), (2, "", "b", 0, "r"), (3, "\n\n  \n", "c", 5, None),
        (None, LONG, "d", 9, "r"), (4, LONG + "\n" + LONG, "e", 9, "r"), (4, LONG + "\n" + LONG, "f", 9, "r"),
        (5, "word " * 60_000 + "\n" + LONG, "g", 9, "r"), (6, "1 2 3 4\n1 2 3 4", "h", 9, "r"), (7, "9 8 7 6", "i", 9, "r"),
    ]
    docs, got = run(spark, rows)
    assert got[1, "a"] == (None, 0, 0) and got[2, "b"] == ("", 1, 0) and got[3, "c"] == ("\n\n  \n", 4, 0)
    assert got[None, "d"] == (LONG, 1, 0)  # null ids order first
    assert got[4, "e"] == got[4, "f"] == ("", 2, 2)
    assert got[5, "g"][1:] == (2, 1)
    assert got[6, "h"][2] == got[7, "i"][2] == 0  # only fields
    out = L.clean(docs)
    assert out.columns == docs.columns and out.schema["n_chars"].dataType == docs.schema["n_chars"].dataType
    kept = {r.lang: r for r in out.collect()}
    assert set(kept) == set("abcdghi") and kept["g"].n_chars == 300_000 and kept["d"].n_chars == 9
    assert L.drop_repeated_lines(docs.limit(0)).count() == 0


def cleaned(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r.text for r in L.clean(docs).collect()}


def test_chain_keeps_what_no_kept_line_stands_for(spark):
    words = LONG.split()
    a = " ".join(words)
    b = " ".join([*words[:4], "changed", *words[5:]])  # A and B differ in one stretch
    c = " ".join([*b.split()[:-1], "yesterday"])  # B and C in another
    d = " ".join([*c.split()[:8], "other", *c.split()[9:]])  # C and D in a third
    tail = ["alpha", "beta", "gamma", "delta"]
    got = cleaned(spark, [(i, f"{t}\nown words of {tail[i]}") for i, t in enumerate((a, b, c, d))])
    assert got[0].startswith(a) and got[1] == "own words of beta"
    assert got[2].startswith(c)  # only B shared a template with C, and B is gone
    assert got[3] == "own words of delta"


def test_documents_that_differ_in_digits_stay(spark):
    text = "Invoice {} of our company for goods shipped on day {} to the usual address of yours"
    got = cleaned(spark, [(1, text.format(17, 4)), (2, text.format(18, 5)), (3, text.format(17, 4)), (4, text.format(18, 5) + "\n\n ")])
    assert got == {1: text.format(17, 4), 2: text.format(18, 5), 4: text.format(18, 5) + "\n\n "}


def test_whole_copies_go(spark):
    body = f"{LONG}\nand one more line which is long enough to be judged here"
    got = cleaned(spark, [(i, body) for i in range(30)] + [(99, None), (98, "")])
    assert got == {0: body, 99: None, 98: ""}
