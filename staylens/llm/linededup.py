"""Line deduplication with a fixed-depth log-template tree, in DataFrame functions only.

A line's tokens with a digit become the field ``<*>``.  Its leaf in the tree is (number of
tokens, first ``DEPTH`` tokens); lines of at least ``WILD_TOKENS`` tokens also stand for
the templates that generalise one of ``SEGMENTS`` equal stretches behind the leading
tokens to ``<*>``.  So two lines of a leaf that differ inside one stretch (a name, an
amount, a replaced word) share a template, and at least four fifths of its tokens agree.
A template recurs if it stands in ``MIN_DOCS`` documents, or ``SHORT_DOCS`` for lines below
``LONG_TOKENS`` tokens, which coincide by chance.  Of a recurring template, the first line
(by document id, then place) stays and every other line is dropped; the first line of a
set of lines linked by templates is therefore always kept.

Scale: lines are hashed in the scan; all grouping is by 64-bit template keys with partial
aggregates, and only leaves that several documents reach are expanded to generalised
templates.  No list of lines or documents of a template is ever built.

Cases: null text stays null, empty text stays empty; blank lines, lines below
``MIN_TOKENS`` tokens and lines that are mostly fields are kept; null ids order first;
rows equal in id and text are one document (they keep the same lines); an empty table gives
no rows; other columns are untouched, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, packed, row_key, store, unpacked

DEPTH = 3
SEGMENTS = 5
WILD_TOKENS = 10
LONG_TOKENS = 8
MIN_TOKENS = 3
MIN_DOCS = 2
SHORT_DOCS = 10
FIELD = "<*>"


def tokens_of(line: Column) -> Column:
    """Tokens of a line, those with a digit as fields (a blank line has none)."""
    masked = F.regexp_replace(line, r"(?<![^ \t\r\f])[^ \t\r\f]*?[0-9][^ \t\r\f]*", FIELD)
    masked = F.when(line.rlike("[0-9]"), masked).otherwise(line)  # most lines have none
    return F.array_remove(F.split(masked, r"[ \t\r\f]+"), "")


def line_keys(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", raw: bool = False) -> DataFrame:
    """(id, key, pos, n, full, leaf, segments[, raw]) of every line that may be judged."""
    # Tokens are made before the explode: behind it, filters would compute them once more.
    def made(line: Column) -> Column:
        return F.struct(tokens_of(line).alias("t"), *([F.xxhash64(line).alias("raw")] if raw else []))

    tokens = docs.select(
        F.col(id_col).alias("id"),
        row_key(id_col, text_col).alias("key"),
        F.posexplode(F.transform(F.split(F.col(text_col), "\n"), made)).alias("pos", "line"),
    ).select("id", "key", "pos", "line.*").withColumn("n", F.size("t"))
    tokens = tokens.where((F.col("n") >= MIN_TOKENS) & (2 * F.size(F.array_remove("t", FIELD)) >= F.col("n")))
    tail, lead = F.col("n") - DEPTH, F.slice("t", 1, DEPTH)
    segments = F.array(*[
        F.xxhash64(F.lit(g), F.slice(F.col("t"), DEPTH + 1 + F.floor(tail * g / SEGMENTS).cast("int"),
                                     (F.floor(tail * (g + 1) / SEGMENTS) - F.floor(tail * g / SEGMENTS)).cast("int")))
        for g in range(SEGMENTS)
    ])
    return tokens.select(
        "id", "key", "pos", "n",
        F.xxhash64("n", "t").alias("full"),
        F.when(F.col("n") >= WILD_TOKENS, F.xxhash64("n", lead)).alias("leaf"),
        F.when(F.col("n") >= WILD_TOKENS, segments).alias("segments"),
        *(["raw"] if raw else []),
    )


def _recurring(rows: DataFrame) -> DataFrame:
    """(template, first_key, first_pos) of the templates that recur; ``rows`` has (template,
    id, key, pos, n)."""
    by_doc = rows.groupBy("template", "key").agg(F.first("id").alias("id"), F.min("pos").alias("pos"), F.first("n").alias("n"))
    need = F.when(F.first("n") >= LONG_TOKENS, MIN_DOCS).otherwise(SHORT_DOCS)
    return (
        by_doc.groupBy("template")
        .agg(F.count("*").alias("docs"), F.min(F.struct("id", "key", "pos")).alias("first"), need.alias("need"))
        .where("docs >= need")
        .select("template", F.col("first.key").alias("first_key"), F.col("first.pos").alias("first_pos"))
    )


def _repeats(rows: DataFrame, name: str) -> DataFrame:
    """(key, pos) of the lines that are not the first of a recurring template; ``rows``
    has (template, id, key, pos, n)."""
    return (
        rows.join(store(_recurring(rows), name), "template")
        .where("NOT (key = first_key AND pos = first_pos)")
        .select("key", "pos")
    )


def repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, pos) of every line to drop, once each."""
    lines = store(line_keys(docs, id_col, text_col), "lines")
    exact = lines.select(F.col("full").alias("template"), "id", "key", "pos", "n")
    return _repeats(exact, "templates").union(_repeats(_generalised(lines), "wild-templates")).distinct()


def _generalised(lines: DataFrame, *more: str) -> DataFrame:
    """(template, id, key, pos, n) of all generalised templates in leaves that several
    documents reach."""
    shared = (
        lines.where("leaf IS NOT NULL").groupBy("leaf")
        .agg(F.min("key").alias("a"), F.max("key").alias("z")).where("a <> z").select("leaf")
    )
    wild = lines.join(store(shared, "leaves"), "leaf").select(
        "leaf", "id", "key", "pos", "n", *more, F.posexplode("segments").alias("g", "own"), "segments"
    )
    rest = [F.when(F.col("g") == g, F.lit(0)).otherwise(F.col("segments")[g]) for g in range(SEGMENTS)]
    return wild.select(F.xxhash64("leaf", "g", *rest).alias("template"), "id", "key", "pos", "n", *more)


def represented_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(key, pos, verbatim) of the lines that a kept line stands for: the lines equal to
    the first of their kind, and all lines of a kind that shares a recurring template with a
    kept kind.  ``verbatim``: the kept line is the same character by character.

    A kind is a line with its fields masked.  Kinds are settled from the first one on: a kind
    is kept if it is the first unsettled kind of each of its templates, and the kinds that
    meet it in a template are then represented.  So of A~B~C (B meets both), A stands for B,
    and C is kept.
    """
    lines = store(line_keys(docs, id_col, text_col, raw=True), "raw-lines")
    exact = lines.select(F.col("full").alias("template"), "id", "key", "pos", "n")
    repeated = store(_recurring(exact).select(F.col("template").alias("full")), "repeated-kinds")
    general = _generalised(lines, "full")
    wild = general.join(_recurring(general).select("template"), "template")
    first = F.min(F.struct("id", "key", "pos"))
    unsettled = store(wild.groupBy("template", "full").agg(first.alias("at")), "template-kinds")
    # One order of kinds in all their templates: by the first line of the kind.
    order = unsettled.groupBy("full").agg(F.min("at").alias("first"))
    unsettled = store(unsettled.select("template", "full").join(order, "full"), "unsettled")
    gone = None
    while True:
        leads = unsettled.groupBy("template").agg(F.min(F.struct("first", "full")).alias("lead"), F.count("*").alias("n"))
        placed = store(unsettled.join(leads, "template").withColumn("leads", F.col("lead.full") == F.col("full")), "placed-kinds")
        kept = placed.groupBy("full").agg(F.min("leads").alias("kept")).where("kept").select("full")
        met = placed.join(kept.select(F.col("full").alias("k")), F.col("lead.full") == F.col("k"), "left_semi").where("NOT leads")
        out = store(met.select("full").distinct(), "represented-kinds")
        gone = out if gone is None else gone.union(out)
        settled = out.union(kept)
        before, unsettled = unsettled, store(unsettled.join(settled, "full", "left_anti"), "unsettled")
        discard(before, placed)
        if unsettled.limit(1).count() == 0:
            break
    by_kept = lines.join(gone, "full", "left_semi").select("key", "pos", F.lit(False).alias("verbatim"))
    own = lines.join(repeated, "full", "left_semi").join(gone, "full", "left_anti")
    heads = own.groupBy("full").agg(F.min(F.struct("id", "key", "pos", "raw")).alias("head"))
    again = own.join(heads, "full").where("NOT (key = head.key AND pos = head.pos)")
    return by_kept.union(again.select("key", "pos", (F.col("raw") == F.col("head.raw")).alias("verbatim")))


def drop_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, text, n_lines, n_dropped): every input row with its remaining text."""
    return _without(docs, repeated_lines(docs, id_col, text_col).withColumn("verbatim", F.lit(True)), id_col, text_col).drop("verbatim")


def _without(docs: DataFrame, dropped: DataFrame, id_col: str, text_col: str) -> DataFrame:
    drops = dropped.groupBy("key").agg(F.collect_set("pos").alias("drops"), F.min("verbatim").alias("verbatim"))
    rows = packed(docs).withColumn("key", row_key(f"row.{id_col}", f"row.{text_col}"))
    text = F.col(f"row.{text_col}")
    lines = F.split(text, "\n")
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("drops"))
    return rows.join(drops, "key", "left").select(
        "row",
        F.when(F.col("drops").isNull(), text)
        .otherwise(F.array_join(F.transform(F.array_sort(kept), lambda i: F.get(lines, i)), "\n")).alias("text"),
        F.when(text.isNull(), 0).otherwise(F.size(lines)).alias("n_lines"),
        F.coalesce(F.size("drops"), F.lit(0)).alias("n_dropped"),
        "verbatim",
    )


def clean(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length_col: str = "n_chars") -> DataFrame:
    """``docs`` without the lines that a kept line stands for (:func:`represented_lines`),
    and with their lengths, where ``length_col`` exists.  A document that would keep no
    words goes if all that it loses stands elsewhere character by character; else it keeps
    its whole text."""
    found = _without(docs, represented_lines(docs, id_col, text_col), id_col, text_col)
    empty = (F.col("n_dropped") > 0) & ~F.coalesce(F.col("text"), F.lit("")).rlike("[^ \t\r\n\f]")
    found = found.where(~(empty & F.col("verbatim")))
    found = found.withColumns({
        "text": F.when(empty, F.col(f"row.`{text_col}`")).otherwise(F.col("text")),
        "n_dropped": F.when(empty, F.lit(0)).otherwise(F.col("n_dropped")),
    })
    out = found.withColumn("row", F.col("row").withField(f"`{text_col}`", F.col("text")))
    if length_col in docs.columns:
        kind = docs.schema[length_col].dataType
        length = F.when(F.col("n_dropped") > 0, F.length("text").cast(kind)).otherwise(F.col(f"row.`{length_col}`"))
        out = out.withColumn("row", F.col("row").withField(f"`{length_col}`", length))
    return unpacked(out, docs)
