"""Model training and explanation with MLlib.

* Split: exact stratified counts (train per class by largest remainder), membership by a
  seeded digest's order within each class; the cuts of all classes are found by counting
  leading bits, so no class is ever ordered as a whole.  Rows sharing a cut's id are counted
  off.  Stable across runs, recomputation and engines.
* Preprocessing: exact median (interpolated) and population standard deviation for
  numeric columns, the most frequent value (smallest on ties) for categorical columns,
  then alphabetical one-hot with unseen values mapped to an all-zero vector.  The fitted
  constants live in a ``SQLTransformer`` so the whole pipeline saves and loads.
* Models: class-balanced logistic regression (L2 equal to C = 1, taken to the optimum by
  Newton steps), a random forest balanced within every bag (``forest.py``) and second-order
  boosted trees (``boost.py``), each a ``PipelineModel``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import OneHotEncoder, SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staylens import config as C
from staylens.functions.draws import BITS, draw60
from staylens.operators.boost import train_boosted
from staylens.operators.forest import impurity_importance, train_forest, tree_nodes
from staylens.operators.linear import coefficient_importance, delta_importance, linear_relation, optimum, permutation_pairs
from staylens.operators.ordered import OrderKey, ordered_prefix, percentile_columns
from staylens.operators.quality import value_counts

LABEL = "target_long_stay"


# Bits of the digest that one counting pass over the rows refines a class's cut by, and the
# number of rows below which the cut is looked for row by row.
CELL_BITS = 12
CELL_ROWS = 100_000


def stratified_split(
    df: DataFrame,
    label_col: str = LABEL,
    test_size: float = 0.20,
    seed: int = C.DEFAULT_SEED,
    id_col: str = "hadm_id",
    cell_rows: int = CELL_ROWS,
    **prefix_kw,
) -> DataFrame:
    """Add ``split`` ('train' / 'test'): n_test = ceil(test_size * n); per-class train
    counts floor(n_c * n_train / n) plus one for the largest remainders (ties by label).

    A class's test part is its first rows by (60-bit digest of the id, id).  The cuts of all
    classes are found together: rows are counted per leading bits of the digest, then inside
    the cells that hold the cuts, and only the last small cells are ordered."""
    y = F.col(label_col)
    keyed = df.withColumn("_h", draw60(seed, "split", F.col(id_col)))
    counted = keyed.groupBy(y.alias("y"), F.shiftright("_h", BITS - CELL_BITS).alias("cell")).agg(F.count(F.lit(1)).alias("n"))
    cells: dict = {}
    for r in counted.collect():  # at most 2^CELL_BITS rows a class
        cells.setdefault(r.y, {})[r.cell] = r.n
    wanted = _test_counts({c: sum(k.values()) for c, k in cells.items()}, test_size)
    cuts = _cuts(keyed, y, id_col, cells, wanted, cell_rows)
    key = F.struct("_h", F.col(id_col).alias("_id"))
    split, partly = F.lit("train"), F.lit(False)
    for c, (h, i, take, at) in cuts.items():
        # Rows that share the cut's digest and id are taken together unless their number is cut.
        cut = F.struct(F.lit(h).cast("long").alias("_h"), F.lit(i).cast(df.schema[id_col].dataType).alias("_id"))
        mine = y.eqNullSafe(F.lit(c))
        split = F.when(mine & F.coalesce((key <= cut) if take == at else (key < cut), F.lit(False)), F.lit("test")).otherwise(split)
        if take < at:
            partly = partly | (mine & key.eqNullSafe(cut))
    if all(take == at for _, _, take, at in cuts.values()):
        return keyed.withColumn("split", split).select(*df.columns, "split")
    tagged = keyed.withColumns({"split": split, "_partly": partly})
    # As many of the rows equal to a cut as are still wanted, in an order over all columns
    # (rows equal in all of them are interchangeable).
    ties = tagged.where("_partly").withColumn("_y", y).withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
    ties = ordered_prefix(ties, ["_y"], [OrderKey("_tie")], **prefix_kw)
    first = F.lit(False)
    for c, (_, _, take, at) in cuts.items():
        first = first | (F.col("_y").eqNullSafe(F.lit(c)) & (F.col("_pos") <= take))
    ties = ties.withColumn("split", F.when(first, F.lit("test")).otherwise(F.lit("train")))
    return tagged.where("NOT _partly").select(*df.columns, "split").union(ties.select(*df.columns, "split"))


def _test_counts(counts: dict, test_size: float) -> dict:
    """Test rows per class: what is left of the largest-remainder allocation to train."""
    n = sum(counts.values())
    n_train = n - math.ceil(float(test_size) * float(n))
    share = {c: float(k) * float(n_train) / float(n) for c, k in counts.items()}
    train = {c: math.floor(s) for c, s in share.items()}
    order = sorted(share, key=lambda c: (-(share[c] - train[c]), c is not None, c if c is not None else 0))
    for c in order[: n_train - sum(train.values())]:
        train[c] += 1
    return {c: counts[c] - train[c] for c in counts}


def _cuts(keyed: DataFrame, y: Column, id_col: str, cells: dict, wanted: dict, cell_rows: int) -> dict:
    """Per class with test rows: digest and id of its last test row, how many rows equal to
    it belong to the test part, and how many there are."""
    bits, at = CELL_BITS, {}
    held = {c: dict(k) for c, k in cells.items() if wanted[c]}
    before = dict.fromkeys(held, 0)
    while True:
        for c, counts in held.items():
            for cell in sorted(counts):
                if before[c] + counts[cell] >= wanted[c]:
                    at[c] = (cell, counts[cell])
                    break
                before[c] += counts[cell]
        if not at:
            return {}
        inside = F.lit(False)
        for c, (cell, _) in at.items():
            inside = inside | (y.eqNullSafe(F.lit(c)) & (F.shiftright("_h", BITS - bits) == cell))
        rows = keyed.where(inside)
        if max(n for _, n in at.values()) <= cell_rows or bits == BITS:
            break
        bits += CELL_BITS
        held = {c: {} for c in at}
        for r in rows.groupBy(y.alias("y"), F.shiftright("_h", BITS - bits).alias("cell")).agg(F.count(F.lit(1)).alias("n")).collect():
            held[r.y][r.cell] = r.n  # at most 2^CELL_BITS rows a class
    ids = rows.groupBy(y.alias("y"), "_h", F.col(id_col).alias("id")).agg(F.count(F.lit(1)).alias("n"))  # below cell_rows rows a class
    upto = Window.partitionBy("y").orderBy("_h", "id").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ends = ids.withColumn("end", F.sum("n").over(upto))
    need = F.lit(None).cast("long")
    for c in at:
        need = F.when(F.col("y").eqNullSafe(F.lit(c)), F.lit(wanted[c] - before[c]).cast("long")).otherwise(need)
    hit = ends.withColumn("need", need).where("end >= need AND end - n < need")
    return {r.y: (r._h, r.id, r.need - (r.end - r.n), r.n) for r in hit.select("y", F.col("_h"), "id", "need", "end", "n").collect()}  # one row per class


def split_counts(split_df: DataFrame, label_col: str = LABEL) -> DataFrame:
    return split_df.groupBy("split", F.col(label_col).alias("label")).agg(F.count(F.lit(1)).alias("n_rows"))


def numeric_and_categorical(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    numeric = [c for c in features if isinstance(df.schema[c].dataType, (T.NumericType, T.BooleanType))]
    return numeric, [c for c in features if c not in numeric]


def preprocess_stats(train: DataFrame, features: Sequence[str], **prefix_kw) -> DataFrame:
    """Long table: feature, kind, median, mean, std (numeric after median fill,
    population std), mode (categorical, smallest on ties)."""
    numeric, categorical = numeric_and_categorical(train, features)
    rows = []
    if numeric:
        pairs = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).cast("double").alias("x")) for c in numeric])
        long = train.select(F.inline(pairs))
        med = percentile_columns(long, "x", {"median": 0.5}, ["feature"], **_times(prefix_kw, len(numeric)))  # one row per numeric feature
        # One row of medians meets every row, so that no row is copied per feature.
        one = med.agg(*[F.max(F.when(F.col("feature") == c, F.col("median"))).alias(f"_m{i}") for i, c in enumerate(numeric)])
        wide = train.select(*[F.col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(numeric)]).crossJoin(F.broadcast(one))
        filled = [F.coalesce(F.col(f"_x{i}"), F.col(f"_m{i}")) for i in range(len(numeric))]
        num = wide.agg(
            F.count(F.lit(1)).alias("_n"),
            *[x for i, v in enumerate(filled) for x in (F.max(f"_m{i}").alias(f"_m{i}"), F.avg(v).alias(f"_a{i}"), F.stddev_pop(v).alias(f"_s{i}"))],
        ).where("_n > 0")
        facts = [
            F.struct(F.lit(c).alias("feature"), F.lit("numeric").alias("kind"), F.col(f"_m{i}").alias("median"), F.col(f"_a{i}").alias("mean"), F.col(f"_s{i}").alias("std"))
            for i, c in enumerate(numeric)
        ]
        rows.append(num.select(F.inline(F.array(*facts))).withColumn("mode", F.lit(None).cast("string")))
    if categorical:
        counts = value_counts(train, categorical)
        observed = F.when(F.col("value").isNotNull(), F.struct((-F.col("n")).alias("n"), "value"))
        cat = counts.groupBy("feature").agg(F.min(observed)["value"].alias("mode"))  # most rows, then least value
        rows.append(
            cat.select(
                "feature", F.lit("categorical").alias("kind"), F.lit(None).cast("double").alias("median"),
                F.lit(None).cast("double").alias("mean"), F.lit(None).cast("double").alias("std"), "mode",
            )
        )
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def _times(prefix_kw: dict, factor: int) -> dict:
    kw = dict(prefix_kw)
    if kw.get("row_bound") is not None:
        kw["row_bound"] *= factor
    return kw


def _sql_number(v) -> str:
    return "CAST(NULL AS DOUBLE)" if v is None or (isinstance(v, float) and math.isnan(v)) else f"CAST({float(v)!r} AS DOUBLE)"


def _sql_text(v) -> str:
    return "CAST(NULL AS STRING)" if v is None else "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def fitted_stats(train: DataFrame, features: Sequence[str], **prefix_kw) -> dict[str, Row]:
    """:func:`preprocess_stats` by feature."""
    return {r["feature"]: r for r in preprocess_stats(train, features, **prefix_kw).collect()}  # one row per feature


def fit_preprocessor(train: DataFrame, features: Sequence[str], stats: dict[str, Row] | None = None) -> tuple[PipelineModel, list[str]]:
    """Fit on the training rows only; returns the pipeline model and its output columns."""
    numeric, categorical = numeric_and_categorical(train, features)
    stats = stats if stats is not None else fitted_stats(train, features)
    # A feature with no observed value is dropped, as the median / most-frequent imputer does.
    numeric = [c for c in numeric if stats[c]["median"] is not None]
    categorical = [c for c in categorical if stats[c]["mode"] is not None]
    selects = []
    for c in numeric:
        s = stats[c]
        std = s["std"] if s["std"] not in (None, 0.0) else 1.0
        selects.append(f"(coalesce(CAST(`{c}` AS DOUBLE), {_sql_number(s['median'])}) - {_sql_number(s['mean'] or 0.0)}) / {_sql_number(std)} AS `{c}__num`")
    for c in categorical:
        selects.append(f"coalesce(CAST(`{c}` AS STRING), {_sql_text(stats[c]['mode'])}) AS `{c}__cat`")
    if not selects:
        raise ValueError("no feature has an observed value in the training rows")
    sql = SQLTransformer(statement="SELECT *, " + ", ".join(selects) + " FROM __THIS__")
    stages = [sql]
    outputs = [f"{c}__num" for c in numeric]
    if categorical:
        stages.append(
            StringIndexer(
                inputCols=[f"{c}__cat" for c in categorical],
                outputCols=[f"{c}__idx" for c in categorical],
                stringOrderType="alphabetAsc",
                handleInvalid="keep",
            )
        )
        stages.append(OneHotEncoder(inputCols=[f"{c}__idx" for c in categorical], outputCols=[f"{c}__ohe" for c in categorical], dropLast=True))
        outputs += [f"{c}__ohe" for c in categorical]
    stages.append(VectorAssembler(inputCols=outputs, outputCol="features", handleInvalid="keep"))
    return Pipeline(stages=stages).fit(train), outputs


def class_weights(train: DataFrame, label_col: str = LABEL, scheme: str = "balanced") -> DataFrame:
    """Per-class weight column: balanced n / (2 n_c), or 'pos_ratio' (neg/pos on positives)."""
    counts = train.groupBy(F.col(label_col).alias("_y")).agg(F.count(F.lit(1)).alias("_nc"))
    tot = Window.partitionBy()
    if scheme == "balanced":
        w = F.sum("_nc").over(tot).cast("double") / (F.lit(2.0) * F.col("_nc").cast("double"))
    else:
        pos = F.sum(F.when(F.col("_y") == 1, F.col("_nc")).otherwise(0)).over(tot).cast("double")
        n = F.sum("_nc").over(tot).cast("double")
        rate = F.when(n > 0, pos / n).otherwise(F.lit(0.5))
        w = F.when(F.col("_y") == 1, (F.lit(1.0) - rate) / F.greatest(rate, F.lit(1e-6))).otherwise(F.lit(1.0))
    return counts.select(F.col("_y").alias(label_col), w.alias("weight"))


def with_weights(train: DataFrame, label_col: str, scheme: str) -> DataFrame:
    return train.join(F.broadcast(class_weights(train, label_col, scheme)), on=label_col, how="left")  # per class


def prepared_rows(train: DataFrame, preprocessor: PipelineModel, label_col: str = LABEL, id_col: str = "hadm_id") -> DataFrame:
    """Training rows as the logistic regression and the forest take them."""
    weighted = with_weights(train, label_col, "balanced").withColumn(label_col, F.col(label_col).cast("double"))
    return preprocessor.transform(weighted).select("features", label_col, "weight", id_col)


def train_model(
    train: DataFrame,
    features: Sequence[str],
    kind: str,
    label_col: str = LABEL,
    seed: int = C.DEFAULT_SEED,
    num_trees: int = 400,
    boost_rounds: int = 300,
    preprocessor: PipelineModel | None = None,
    id_col: str = "hadm_id",
    stats: dict[str, Row] | None = None,
    prepared: DataFrame | None = None,
) -> PipelineModel:
    """kind: logistic_regression | random_forest | gradient_boosted_trees.  A fitted
    ``preprocessor`` (from :func:`fit_preprocessor` on the same rows), their ``stats`` and
    ``prepared`` rows (:func:`prepared_rows`, persisted by the caller) are reused if given."""
    if kind == "gradient_boosted_trees":
        return train_boosted(train, features, label_col, id_col, seed, boost_rounds, stats=stats).pipeline()
    pre = preprocessor if preprocessor is not None else fit_preprocessor(train, features, stats)[0]
    own = prepared is None
    if own:
        prepared = prepared_rows(train, pre, label_col, id_col).cache()
    try:
        if kind == "logistic_regression":
            total_w = prepared.agg(F.sum("weight")).first()[0] or 1.0
            est = LogisticRegression(featuresCol="features", labelCol=label_col, weightCol="weight", maxIter=2000,
                                     regParam=1.0 / total_w, elasticNetParam=0.0, standardization=False, tol=1e-4)
            fitted = optimum(prepared, est)
        elif kind == "random_forest":
            fitted = train_forest(prepared, num_trees, label_col, id_col, seed=seed)
        else:
            raise ValueError(f"unknown model kind: {kind}")
    finally:
        if own:
            prepared.unpersist()
    return PipelineModel(stages=[*pre.stages, fitted])


def positive_probability(scored: DataFrame) -> Column:
    """The positive class's probability, whether classes are a vector or an array."""
    if isinstance(scored.schema["probability"].dataType, T.ArrayType):
        return F.col("probability")[1]
    return vector_to_array("probability")[1]


def predict_scores(model: PipelineModel, df: DataFrame, name: str, label_col: str = LABEL, id_col: str = "hadm_id") -> DataFrame:
    """model, id, y_true, y_pred (class at 0.5), y_score (positive-class probability)."""
    out = model.transform(df)
    return out.select(
        F.lit(name).alias("model"),
        F.col(id_col),
        F.col(label_col).cast("int").alias("y_true"),
        F.col("prediction").cast("int").alias("y_pred"),
        positive_probability(out).alias("y_score"),
    )


def run_baseline_model_suite(
    train: DataFrame,
    test: DataFrame,
    features: Sequence[str],
    include_boosted: bool = True,
    label_col: str = LABEL,
    seed: int = C.DEFAULT_SEED,
    num_trees: int = 400,
    boost_rounds: int = 300,
) -> tuple[dict[str, PipelineModel], DataFrame, str]:
    """Models by name, one long scored table over the test rows, boosted-model status."""
    kinds = ["logistic_regression", "random_forest"] + (["gradient_boosted_trees"] if include_boosted else [])
    # One fit of the shared preprocessing, and one pass of the rows through it.
    stats = fitted_stats(train, features)
    pre, _ = fit_preprocessor(train, features, stats)
    prepared = prepared_rows(train, pre, label_col).cache()
    try:
        models = {k: train_model(train, features, k, label_col, seed, num_trees, boost_rounds, pre, stats=stats, prepared=prepared) for k in kinds}
    finally:
        prepared.unpersist()
    scored = None
    for name, m in models.items():
        part = predict_scores(m, test, name, label_col)
        scored = part if scored is None else scored.unionByName(part)
    return models, scored, "trained" if include_boosted else "not_requested"


def feature_names(model: PipelineModel, sample: DataFrame) -> list[str]:
    """Expanded input names of the final feature vector (from ML attribute metadata)."""
    meta = model.transform(sample.limit(0)).schema["features"].metadata.get("ml_attr", {})
    attrs = []
    for group in meta.get("attrs", {}).values():
        attrs.extend(group)
    names = [""] * meta.get("num_attrs", len(attrs))
    for a in attrs:
        names[a["idx"]] = a["name"].replace("__num", "").replace("__ohe_", "_")
    return names


def logistic_importance(spark: SparkSession, model: PipelineModel, top_n: int = 20) -> DataFrame:
    """Coefficients of the expanded columns by absolute value."""
    return coefficient_importance(linear_relation(spark, model), top_n)


def tree_importance(model: PipelineModel, names: list[str], top_n: int = 20) -> DataFrame:
    """Impurity importance of a forest's columns, from its trees as a node table."""
    return impurity_importance(tree_nodes(model.stages[-1]), names).orderBy(F.desc("importance"), "feature").limit(top_n)


def permuted_copies(
    test: DataFrame,
    features: Sequence[str],
    n_repeats: int,
    seed: int = C.DEFAULT_SEED,
    id_col: str = "hadm_id",
    **prefix_kw,
) -> tuple[DataFrame, DataFrame]:
    """(rows by position, copies): every row once per feature and repeat (``_feature``,
    ``_r``), with that feature taken from another row of the repeat's permutation."""
    base, pairs = permutation_pairs(test, n_repeats, seed, id_col, **prefix_kw)
    values = base.select(F.col("_i").alias("_from"), F.struct(*[F.col(f).alias(f) for f in features]).alias("_v"))
    rows = pairs.join(values, "_from").join(base, "_i")
    swapped = F.array(*[
        F.struct(F.lit(feat).alias("_feature"), *[(F.col(f"_v.{f}") if f == feat else F.col(f)).alias(f) for f in features]) for feat in features
    ])
    kept = [c for c in test.columns if c not in features]
    return base, rows.select("_r", *kept, F.inline(swapped))


def permutation_importance(
    model: PipelineModel,
    test: DataFrame,
    features: Sequence[str],
    n_repeats: int = 20,
    seed: int = C.DEFAULT_SEED,
    top_n: int = 20,
    label_col: str = LABEL,
    id_col: str = "hadm_id",
    **prefix_kw,
) -> DataFrame:
    """Accuracy drop when one raw feature is permuted, mean and population std over repeats.

    A linear model is scored by the change of one feature's contribution
    (``linear.delta_importance``).  For others all (feature, repeat) copies
    (:func:`permuted_copies`) are one long table scored in a single ``transform``.  A
    repeat's permutation pairs row position i (id order) with the row at position i of a
    seeded digest's order."""
    if isinstance(model.stages[-1], LogisticRegressionModel):
        relation = linear_relation(test.sparkSession, model)
        return delta_importance(test, relation, features, n_repeats, seed, top_n, label_col, id_col, **prefix_kw)
    base, copies = permuted_copies(test, features, n_repeats, seed, id_col, **prefix_kw)
    baseline = model.transform(base).select(F.avg((F.col("prediction") == F.col(label_col).cast("double")).cast("double")).alias("_acc0"))
    scored = model.transform(copies)
    acc = scored.groupBy("_feature", "_r").agg(F.avg((F.col("prediction") == F.col(label_col).cast("double")).cast("double")).alias("_acc"))
    drops = acc.crossJoin(F.broadcast(baseline)).withColumn("_d", F.col("_acc0") - F.col("_acc"))
    out = drops.groupBy(F.col("_feature").alias("feature")).agg(F.avg("_d").alias("importance_mean"), F.stddev_pop("_d").alias("importance_std"))
    return out.orderBy(F.desc("importance_mean"), "feature").limit(top_n)
