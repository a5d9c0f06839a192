"""Metrics, splits, balancing, neighbours, models and comparisons.

The labelled documents (four unequal classes) and the parts carry the model queries.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.hashing import hash32, hash32_sql
from ..operators import evaluate as E
from ..operators import metrics as M
from ..operators import models as L
from ..operators import neighbors as N
from ..operators import resample as R
from ..operators import scale as S
from ..operators import split as P
from ..operators.boosting import Boosted
from ..sources.tables import table
from .profiles import rounded
from .registry import query

DOC_FEATURES = ["chars", "words", "lines", "digits", "marks"]
PART_FEATURES = ["size", "name_length", "key"]


def labelled(spark, sf):
    """(row_id, label) of the labelled documents."""
    return table(spark, sf, "labels").select(F.col("doc_id").alias("row_id"), (F.col("quality") * 2 + F.col("toxic")).alias("label"))


def documents(spark, sf):
    """Labelled documents with counts over their whole texts as features."""
    d = table(spark, sf, "documents").select("doc_id", "text", "n_chars")
    text = F.col("text")
    counted = d.select(
        F.col("doc_id").alias("row_id"), F.col("n_chars").cast("double").alias("chars"),
        F.regexp_count(text, F.lit(r"\S+")).cast("double").alias("words"), F.regexp_count(text, F.lit("\n")).cast("double").alias("lines"),
        F.regexp_count(text, F.lit(r"\d")).cast("double").alias("digits"), F.regexp_count(text, F.lit(r"[^\w\s]")).cast("double").alias("marks"))
    return counted.join(labelled(spark, sf), "row_id")


def parts(spark, sf):
    return table(spark, sf, "part").select(
        F.col("p_partkey").alias("row_id"), F.col("p_retailprice").alias("label"), F.col("p_size").cast("double").alias("size"),
        F.length("p_name").cast("double").alias("name_length"), F.col("p_partkey").cast("double").alias("key"))


_L = "y AS (SELECT doc_id AS row_id, quality * 2 + toxic AS label FROM labels)"
_HASH = hash32_sql("row_id", "42")
_PLACED = f"p AS (SELECT *, row_number() OVER (ORDER BY {_HASH}, row_id) AS pos, count(*) OVER () AS n FROM y)"
_STRATA = f"p AS (SELECT *, row_number() OVER (PARTITION BY label ORDER BY {_HASH}, row_id) AS pos, count(*) OVER (PARTITION BY label) AS n FROM y)"
_GUESS = f"CAST(CASE WHEN {hash32_sql('row_id', '7')} % 3 = 0 THEN {hash32_sql('row_id', '8')} % 4 ELSE label END AS INTEGER)"


def guessed(spark, sf):
    """Fixed-rule prediction: right for two thirds of the documents."""
    h = hash32(F.col("row_id"), 7) % 3 == 0
    return labelled(spark, sf).withColumn("prediction", F.when(h, hash32(F.col("row_id"), 8) % 4).otherwise(F.col("label")).cast("int"))


_G = f"WITH {_L}, g AS (SELECT row_id, label, {_GUESS} AS prediction FROM y)"
_CM = (_G + ", c AS (SELECT label AS actual, prediction AS predicted, count(*) AS n FROM g GROUP BY 1, 2), "
       "k AS (SELECT DISTINCT label AS v FROM g UNION SELECT DISTINCT prediction FROM g), "
       "cm AS (SELECT a.v AS actual, b.v AS predicted, coalesce(n, 0) AS n FROM k a CROSS JOIN k b LEFT JOIN c ON c.actual = a.v AND c.predicted = b.v)")


@query("agg11_confusion_matrix", _CM + " SELECT actual, predicted, n FROM cm")
def confusion_matrix(spark, sf):
    return M.confusion(guessed(spark, sf), "label", "prediction")


@query("agg12_global_accuracy", _CM + " SELECT round(sum(n) FILTER (actual = predicted) / sum(n), 6) AS accuracy, round(1 - sum(n) FILTER (actual = predicted) / sum(n), 6) AS error FROM cm")
def global_accuracy(spark, sf):
    return rounded(M.accuracy_table(M.label_counts(guessed(spark, sf), "label", "prediction")))


@query("agg12_class_rates", _CM + " SELECT actual, round(coalesce(sum(n) FILTER (actual = predicted) / sum(n), 0), 6) AS rate FROM cm GROUP BY actual HAVING sum(n) > 0")
def class_rates(spark, sf):
    return rounded(M.class_rates(M.label_counts(guessed(spark, sf), "label", "prediction")))


_W = (_CM + ", s AS (SELECT v, (SELECT sum(n) FROM cm WHERE actual = v) AS sup, (SELECT sum(n) FROM cm WHERE predicted = v) AS cl, (SELECT sum(n) FROM cm WHERE actual = v AND predicted = v) AS tp FROM k), "
      "q AS (SELECT sup, tp, CASE WHEN cl = 0 THEN 0 ELSE tp / cl END AS p, CASE WHEN sup = 0 THEN 0 ELSE tp / sup END AS r FROM s)")


@query("agg13_weighted_scores", _W + " SELECT round(sum(tp) / sum(sup), 6) AS accuracy, round(sum(p * sup) / sum(sup), 6) AS precision_weighted, round(sum(r * sup) / sum(sup), 6) AS recall_weighted, "
       "round(sum(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END * sup) / sum(sup), 6) AS f1_weighted FROM q")
def weighted_scores(spark, sf):
    return rounded(M.weighted_scores(guessed(spark, sf), "label", "prediction"))


@query("agg13_macro_scores", _W + " SELECT round(avg(p), 6) AS precision_macro, round(avg(r), 6) AS recall_macro, round(avg(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END), 6) AS f1_macro, "
       "round(avg(r) FILTER (sup > 0), 6) AS balanced_accuracy FROM q")
def macro_scores(spark, sf):
    return rounded(M.class_scores(guessed(spark, sf), "label", "prediction"))


def _priced(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_totalprice").alias("y"), (F.col("o_totalprice") * 0.9 + F.col("o_custkey") % 1000 * 20).alias("f"))


_EF = "WITH e AS (SELECT o_totalprice AS y, o_totalprice * 0.9 + o_custkey % 1000 * 20 AS f FROM orders)"


@query("agg14_relative_errors", _EF + ' SELECT round(1 - var_pop(y - f) / var_pop(y), 6) AS explained_variance, round(avg(abs(y - f) / abs(y)) FILTER (y <> 0), 6) AS "MAPE", round(max(abs(y - f)), 4) AS max_error FROM e')
def relative_errors(spark, sf):
    out = M.relative_errors(_priced(spark, sf), "y", "f")
    return out.select(F.round("explained_variance", 6).alias("explained_variance"), F.round("MAPE", 6).alias("MAPE"), F.round("max_error", 4).alias("max_error"))


@query("agg14_regression_errors", _EF + ' SELECT round(sqrt(avg((f - y) ** 2)), 4) AS "RMSE", round(avg(abs(f - y)), 4) AS "MAE", round(sum(abs(f - y)) / sum(abs(y)), 6) AS "ER" FROM e')
def regression_errors(spark, sf):
    return M.regression_errors(_priced(spark, sf), "y", "f").select(F.round("RMSE", 4).alias("RMSE"), F.round("MAE", 4).alias("MAE"), F.round("ER", 6).alias("ER"))


@query("agg15_fit_measures", _EF + ' SELECT round(avg((f - y) ** 2) / 1e6, 4) AS "MSE", round(avg(abs(f - y)), 4) AS "MAE", round(1 - sum((f - y) ** 2) / (var_pop(y) * count(*)), 6) AS "R2" FROM e')
def fit_measures(spark, sf):
    return M.regression_errors(_priced(spark, sf), "y", "f").select(F.round(F.col("MSE") / 1e6, 4).alias("MSE"), F.round("MAE", 4).alias("MAE"), F.round("R2", 6).alias("R2"))


@query("agg20_fold_summary",
       f"WITH {_L}, {_PLACED}, s AS (SELECT (pos - 1) % 5 AS fold, avg(CASE WHEN label = {_GUESS} THEN 1.0 ELSE 0.0 END) AS v FROM p GROUP BY 1) "
       "SELECT 'rule' AS model, 'accuracy' AS metric, round(avg(v), 6) AS mean, round(stddev_pop(v), 6) AS std, round(min(v), 6) AS min, round(max(v), 6) AS max FROM s")
def fold_summary(spark, sf):
    folds = P.kfold(guessed(spark, sf), "row_id", 5)
    scores = folds.groupBy("fold").agg(F.avg((F.col("label") == F.col("prediction")).cast("double")).alias("value"))
    return rounded(M.fold_summary(scores.select(F.lit("rule").alias("model"), F.lit("accuracy").alias("metric"), "value")))


@query("prep1_random_split", f"WITH {_L}, {_PLACED} SELECT row_id, CASE WHEN pos <= ceil(n * 0.25) THEN 'test' ELSE 'train' END AS split FROM p")
def random_split(spark, sf):
    return P.random_split(labelled(spark, sf), "row_id").select("row_id", "split")


@query("prep1_encoded_split",
       "WITH y AS (SELECT o_orderkey AS row_id, o_totalprice, o_orderstatus FROM orders), c AS (SELECT o_orderstatus AS v, dense_rank() OVER (ORDER BY o_orderstatus) - 1 AS code FROM (SELECT DISTINCT o_orderstatus FROM orders)), "
       f"{_PLACED} SELECT row_id, o_totalprice, code :: DOUBLE AS o_orderstatus, CASE WHEN pos <= ceil(n * 0.25) THEN 'test' ELSE 'train' END AS split FROM p JOIN c ON o_orderstatus = v")
def encoded_split(spark, sf):
    from ..operators.encode import coerce_numeric
    df = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), "o_totalprice", "o_orderstatus")
    return P.random_split(coerce_numeric(df, exclude=("row_id",)), "row_id")


@query("prep2_stratified_split", f"WITH {_L}, {_STRATA} SELECT row_id, label, CASE WHEN pos <= round(n * 0.25) THEN 'test' ELSE 'train' END AS split FROM p")
def stratified_split(spark, sf):
    return P.stratified_split(labelled(spark, sf), "row_id", "label").select("row_id", "label", "split")


@query("prep3_training_statistics",
       "WITH y AS (SELECT p_partkey AS row_id, CASE WHEN p_size % 9 = 0 THEN NULL ELSE p_size :: DOUBLE END AS x FROM part), "
       f"{_PLACED}, m AS (SELECT median(x) AS m FROM p WHERE pos > ceil(n * 0.25)), f AS (SELECT row_id, pos > ceil(n * 0.25) AS train, coalesce(x, m) AS x FROM p, m), "
       "s AS (SELECT avg(x) AS a, stddev_pop(x) AS d FROM f WHERE train) SELECT row_id, round((x - a) / d, 6) AS x FROM f, s")
def training_statistics(spark, sf):
    df = table(spark, sf, "part").selectExpr("p_partkey AS row_id", "CASE WHEN p_size % 9 = 0 THEN NULL ELSE CAST(p_size AS DOUBLE) END AS x", "p_retailprice AS label")
    parted = P.random_split(df, "row_id")
    ready = L.Prepared(parted.where("split = 'train'"), ["x"], True)
    from pyspark.ml.functions import vector_to_array
    return ready.apply(parted, ["row_id"]).select("row_id", F.round(vector_to_array("features")[0], 6).alias("x"))


_DRAWN = ("t AS (SELECT max(n) AS top FROM p), d AS (SELECT label, n, unnest(range(1, top - n + 1)) AS j FROM (SELECT DISTINCT label, n FROM p), t WHERE n < top), "
          f"k AS (SELECT label, j, {hash32_sql('label', 'j', '42')} % n + 1 AS pick FROM d)")


@query("bal1_oversample", f"WITH {_L}, {_STRATA}, {_DRAWN} SELECT row_id, label, 0 :: BIGINT AS copy FROM y UNION ALL SELECT p.row_id, p.label, j FROM k JOIN p ON p.label = k.label AND p.pos = k.pick")
def oversample(spark, sf):
    return R.oversample(labelled(spark, sf), "row_id", "label")


@query("bal2_undersample", f"WITH {_L}, {_STRATA} SELECT row_id, label FROM p WHERE pos <= (SELECT min(n) FROM p)")
def undersample(spark, sf):
    return R.undersample(labelled(spark, sf), "row_id", "label")


@query("jn3_row_gather", f"WITH {_L}, {_STRATA}, {_DRAWN} SELECT p.row_id, count(*) AS copies FROM k JOIN p ON p.label = k.label AND p.pos = k.pick GROUP BY 1")
def row_gather(spark, sf):
    return R.oversample(labelled(spark, sf), "row_id", "label").where("copy > 0").groupBy("row_id").agg(F.count(F.lit(1)).alias("copies"))


_F = ("f AS (SELECT row_id, label, n_chars :: DOUBLE AS chars, len(regexp_extract_all(text, '\\S+')) :: DOUBLE AS words, len(regexp_extract_all(text, '\\n')) :: DOUBLE AS lines, "
      "len(regexp_extract_all(text, '\\d')) :: DOUBLE AS digits, len(regexp_extract_all(text, '[^\\w\\s]')) :: DOUBLE AS marks FROM y JOIN documents ON row_id = doc_id)")
_NN_DIST = "sqrt((a.chars - b.chars) ** 2 + (a.words - b.words) ** 2 + (a.lines - b.lines) ** 2 + (a.digits - b.digits) ** 2 + (a.marks - b.marks) ** 2)"


@query("bal3_smote",
       f"WITH {_L}, {_STRATA}, {_F}, {_DRAWN}, nd AS (SELECT a.row_id AS qid, b.row_id AS pid, {_NN_DIST} AS d FROM f a JOIN f b ON a.label = b.label AND a.row_id <> b.row_id), "
       "nr AS (SELECT qid, pid, row_number() OVER (PARTITION BY qid ORDER BY round(d, 12), pid) AS rank FROM nd), "
       f"dr AS (SELECT k.label, k.j, p.row_id, {hash32_sql('k.label', 'j', '42', chr(39) + 'n' + chr(39))} % least(4, n - 1) + 1 AS rank, "
       f"({hash32_sql('k.label', 'j', '42', chr(39) + 'g' + chr(39))} + 0.5) / 4294967296.0 AS gap FROM k JOIN p ON p.label = k.label AND p.pos = k.pick WHERE n > 1) "
       "SELECT chars, words, lines, digits, marks, label, CAST(NULL AS BIGINT) AS source, CAST(NULL AS BIGINT) AS neighbour, CAST(NULL AS DOUBLE) AS gap FROM f UNION ALL SELECT "
       + ", ".join(f"round(a.{c} + gap * (b.{c} - a.{c}), 4)" for c in DOC_FEATURES) +
       ", a.label, a.row_id, b.row_id, round(gap, 4) FROM dr JOIN nr ON nr.qid = dr.row_id AND nr.rank = dr.rank JOIN f a ON a.row_id = dr.row_id JOIN f b ON b.row_id = nr.pid")
def smote(spark, sf):
    return rounded(R.smote(documents(spark, sf), "row_id", "label", DOC_FEATURES), 4)


@query("bal3_smote_class_sizes", f"WITH {_L}, c AS (SELECT label, count(*) AS n FROM y GROUP BY 1) SELECT label, CASE WHEN n > 1 THEN (SELECT max(n) FROM c) ELSE n END AS n FROM c")
def smote_sizes(spark, sf):
    return R.smote(documents(spark, sf), "row_id", "label", DOC_FEATURES).groupBy("label").agg(F.count(F.lit(1)).alias("n"))


@query("bal4_class_weights", f"WITH {_L}, {_STRATA} SELECT row_id, label, round((SELECT count(*) FROM y) / ((SELECT count(DISTINCT label) FROM y) * n), 6) AS weight FROM p")
def class_weights(spark, sf):
    return rounded(R.class_weights(labelled(spark, sf), "label"))


@query("cv1_kfold", f"WITH {_L}, {_PLACED} SELECT row_id, CAST((pos - 1) % 10 AS INTEGER) AS fold FROM p")
def kfold(spark, sf):
    return P.kfold(labelled(spark, sf), "row_id").select("row_id", "fold")


@query("cv2_stratified_kfold", f"WITH {_L}, {_STRATA} SELECT row_id, label, CAST((pos - 1) % least(10, (SELECT min(n) FROM p)) AS INTEGER) AS fold FROM p")
def stratified_kfold(spark, sf):
    return P.stratified_kfold(labelled(spark, sf), "row_id", "label")[0].select("row_id", "label", "fold")


@query("cv3_time_folds", "WITH p AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS pos, count(*) OVER () AS n FROM events) "
       "SELECT event_id, CAST(greatest(0, 5 - (n - pos) // (n // 6)) AS INTEGER) AS fold FROM p")
def time_folds(spark, sf):
    return P.time_folds(table(spark, sf, "events").select("event_id", "ts"), "ts", 5, ["event_id"]).select("event_id", "fold")


@query("win8_expanding_folds", "WITH p AS (SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS pos, count(*) OVER () AS n FROM orders), "
       "f AS (SELECT greatest(0, 4 - (n - pos) // (n // 5)) AS fold FROM p) SELECT CAST(k AS INTEGER) AS fold, count(*) FILTER (fold < k) AS n_train, count(*) FILTER (fold = k) AS n_test FROM f, (SELECT unnest(range(1, 5)) AS k) GROUP BY k")
def expanding_folds(spark, sf):
    folds = P.time_folds(table(spark, sf, "orders").select("o_orderkey", "o_orderdate"), "o_orderdate", 4, ["o_orderkey"])
    sizes = folds.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    arms = F.array(*[F.struct(F.lit(k).alias("k"), F.when(F.col("fold") < k, F.col("n")).otherwise(0).alias("tr"),
                              F.when(F.col("fold") == k, F.col("n")).otherwise(0).alias("te")) for k in range(1, 5)])
    return sizes.select(F.explode(arms).alias("a")).groupBy(F.col("a.k").alias("fold")).agg(F.sum("a.tr").alias("n_train"), F.sum("a.te").alias("n_test"))


def vectors(spark, sf):
    return table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"), F.col("embedding").cast("array<double>").alias("x"), "label")


_D = ("list_reduce(list_transform(list_zip(a.embedding, b.embedding), lambda z: (z[1] :: DOUBLE - z[2] :: DOUBLE) ** 2), lambda s, v: s + v)")


@query("jn4_nearest_neighbours", f"WITH d AS (SELECT a.vec_id AS qid, b.vec_id AS pid, sqrt({_D}) AS dist FROM embeddings a JOIN embeddings b ON a.vec_id <> b.vec_id), "
       "r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(dist, 12), pid) AS rank FROM d) SELECT qid, pid, round(dist, 6) AS dist, CAST(rank AS INTEGER) AS rank FROM r WHERE rank <= 5")
def nearest_neighbours(spark, sf):
    v = vectors(spark, sf)
    near = N.nearest(v.select(F.col("row_id").alias("qid"), "x"), v.select(F.col("row_id").alias("pid"), "x"), 5, same_rows=True)
    return rounded(near, 6)


@query("cls1_knn", f"WITH y AS (SELECT vec_id AS row_id, embedding, label FROM embeddings), {_PLACED}, t AS (SELECT *, pos <= ceil(n * 0.25) AS test FROM p), "
       f"d AS (SELECT a.row_id AS qid, a.label AS y, b.row_id AS pid, b.label, sqrt({_D}) AS dist FROM t a JOIN t b ON a.test AND NOT b.test), "
       "r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(dist, 12), pid) AS rank FROM d), "
       "v AS (SELECT qid, any_value(y) AS y, label, count(*) AS n FROM r WHERE rank <= 3 GROUP BY qid, label) "
       "SELECT qid AS row_id, y AS label, label AS prediction FROM v QUALIFY row_number() OVER (PARTITION BY qid ORDER BY n DESC, label) = 1")
def knn(spark, sf):
    parted = P.random_split(vectors(spark, sf), "row_id")
    train, test = parted.where("split = 'train'"), parted.where("split = 'test'")
    near = N.nearest(test.select(F.col("row_id").alias("qid"), "x"), train.select(F.col("row_id").alias("pid"), "x"), 3)
    votes = N.vote(near, train.select(F.col("row_id").alias("pid"), "label"))
    return test.select("row_id", "label").join(votes.withColumnRenamed("qid", "row_id"), "row_id")


def _classified(spark, sf, factory, params, **options):
    parted = P.stratified_split(documents(spark, sf), "row_id", "label")
    _, tables = E.train_classifier(parted, DOC_FEATURES, factory, params, **options)
    return tables["confusion"]


@query("cls2_decision_tree")
def decision_tree(spark, sf):
    return _classified(spark, sf, L.decision_tree, {}, scale=False)


@query("cls3_random_forest")
def random_forest(spark, sf):
    return _classified(spark, sf, L.random_forest, {"n_estimators": 20, "max_depth": 8}, scale=False)


@query("cls4_gradient_boosting")
def gradient_boosting(spark, sf):
    return _classified(spark, sf, L.gradient_boosting, {"n_estimators": 5}, scale=False)


_STEPS = "z AS (SELECT row_id, label, " + ", ".join(f"round(8 * log2(1 + {c})) AS {c}" for c in DOC_FEATURES) + " FROM f), "
_LONG = "x AS (" + " UNION ALL ".join(f"SELECT row_id, {i} AS f, {c} AS x FROM z" for i, c in enumerate(DOC_FEATURES)) + "), "


def _grown_sql(level):
    """CTEs that part every open node of all classes' trees once more."""
    at = f"t{level}"
    return (f"a{level} AS (SELECT c, path, f, x, count(*) * any_value(u) AS w, count(*) AS n, sum(g) AS g FROM {at} JOIN x USING (row_id) WHERE length(path) = {level} GROUP BY 1, 2, 3, 4), "
            f"s{level} AS (SELECT *, sum(w) OVER r AS wl, sum(g) OVER r AS gl, sum(w) OVER a AS wa, sum(g) OVER a AS ga FROM a{level} "
            "WINDOW r AS (PARTITION BY c, path, f ORDER BY x), a AS (PARTITION BY c, path, f)), "
            f"e{level} AS (SELECT *, gl / wl - (ga - gl) / (wa - wl) AS apart FROM s{level} WHERE wa > wl), "
            f"b{level} AS (SELECT c, path, f AS bf, x AS bx FROM e{level} WHERE abs(apart) > 1e-9 "
            "QUALIFY row_number() OVER (PARTITION BY c, path ORDER BY wl * (wa - wl) / wa * apart * apart DESC, f, x) = 1), "
            f"t{level + 1} AS (SELECT row_id, c, path || CASE WHEN bf IS NULL THEN '' WHEN x > bx THEN 'R' ELSE 'L' END AS path, g, h, u "
            f"FROM {at} LEFT JOIN b{level} USING (c, path) LEFT JOIN x USING (row_id) WHERE bf IS NULL AND (x.f = 0) OR x.f = bf), ")


@query("cls4_first_trees",
       f"WITH {_L}, {_F}, {_STEPS}{_LONG}"
       "p AS (SELECT label AS c, count(*) / (SELECT count(*) FROM z) AS p FROM z GROUP BY label), "
       "v AS (SELECT pow(2, least(36, 61 - ceil(log2(count(*) + 1)))) AS u FROM z), "
       "t0 AS (SELECT row_id, c, '' AS path, round((CASE WHEN label = c THEN 1 ELSE 0 END - p) * u) AS g, round(p * (1 - p) * u) AS h, u FROM z, p, v), "
       + _grown_sql(0) + _grown_sql(1) +
       "k AS (SELECT count(*) AS k FROM p) "
       "SELECT c :: DOUBLE AS label, path, count(*) AS n_rows, round(0.1 * (any_value(k) - 1) / any_value(k) * sum(g) / sum(h), 6) AS value FROM t2, k GROUP BY c, path")
def first_trees(spark, sf):
    """Leaves of the first round's trees of depth 2, one tree per class; the features are rounded logarithms."""
    docs = documents(spark, sf)
    steps = F.array(*[F.round(8 * F.log2(1 + F.col(c))) for c in DOC_FEATURES])
    model = Boosted(1, 2).fit(docs.select(steps.alias("features"), "label"))
    return rounded(spark.createDataFrame(model.leaves(), "round int, label double, path string, n_rows bigint, value double").drop("round"))


@query("cls5_ada_boost")
def ada_boost(spark, sf):
    return _classified(spark, sf, L.ada_boost, {"n_estimators": 8}, scale=False)


def _line_features(spark, sf):
    return table(spark, sf, "lineitem").select(F.monotonically_increasing_id().alias("row_id"), F.col("l_extendedprice").alias("label"), F.col("l_quantity").alias("q"))


def _coefficients(spark, model):
    return spark.createDataFrame([(float(model.coefficients[0]), float(model.intercept))], "slope double, intercept double").select(
        F.round("slope", 3).alias("slope"), F.round("intercept", 2).alias("intercept"))


def _fitted(spark, sf, learner, scale):
    df = _line_features(spark, sf)
    ready = L.Prepared(df, ["q"], scale)
    return _coefficients(spark, learner.fit(ready.apply(df, ["row_id", "label"])))


@query("reg1_linear", "SELECT round(regr_slope(l_extendedprice, l_quantity), 3) AS slope, round(regr_intercept(l_extendedprice, l_quantity), 2) AS intercept FROM lineitem")
def linear(spark, sf):
    return _fitted(spark, sf, L.linear({}), False)


_COV = "WITH m AS (SELECT covar_pop(l_quantity, l_extendedprice) / stddev_pop(l_quantity) AS c, avg(l_extendedprice) AS a, count(*) AS n FROM lineitem)"


@query("reg2_lasso", _COV + " SELECT round(sign(c) * greatest(abs(c) - 100.0, 0), 3) AS slope, round(a, 2) AS intercept FROM m")
def lasso(spark, sf):
    return _fitted(spark, sf, L.lasso({"alpha": 100.0}), True)


@query("reg3_ridge", _COV + " SELECT round(c * n / (n + 500.0), 3) AS slope, round(a, 2) AS intercept FROM m")
def ridge(spark, sf):
    return _fitted(spark, sf, L.ridge({"alpha": 500.0}), True)


def _regressed(spark, sf, factory, params, scale):
    _, errors = E.train_regressor(P.random_split(parts(spark, sf), "row_id"), PART_FEATURES, factory, params, scale=scale)
    return rounded(errors.select("RMSE", "MAE", "ER"))


@query("reg4_support_vector")
def support_vector(spark, sf):
    return _regressed(spark, sf, L.support_vector, {"iterations": 15, "width": 100}, True)


@query("reg5_decision_tree")
def regression_tree(spark, sf):
    return _regressed(spark, sf, L.tree_regressor, {}, False)


@query("reg6_random_forest")
def regression_forest(spark, sf):
    return _regressed(spark, sf, L.forest_regressor, {"n_estimators": 10, "max_depth": 8}, False)


@query("reg7_gradient_boosting")
def regression_boosting(spark, sf):
    return _regressed(spark, sf, L.boosted_regressor, {"n_estimators": 10}, False)


_SCALED = ", ".join(f"({c} - (SELECT avg({c}) FROM tr)) / (SELECT stddev_pop({c}) FROM tr) AS {c}" for c in DOC_FEATURES)


@query("eva1_fit_and_score",
       f"WITH {_L}, {_STRATA}, {_F}, t AS (SELECT f.*, pos <= round(n * 0.25) AS test FROM f JOIN p ON f.row_id = p.row_id), tr AS (SELECT * FROM t WHERE NOT test), "
       f"z AS (SELECT row_id, label, test, {_SCALED} FROM t), d AS (SELECT a.row_id AS qid, a.label AS y, b.row_id AS pid, b.label, {_NN_DIST} AS d FROM z a JOIN z b ON a.test AND NOT b.test), "
       "r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(d, 12), pid) AS rank FROM d), "
       "v AS (SELECT qid, any_value(y) AS y, label, count(*) AS n FROM r WHERE rank <= 3 GROUP BY qid, label), "
       "w AS (SELECT qid, y, label FROM v QUALIFY row_number() OVER (PARTITION BY qid ORDER BY n DESC, label) = 1) "
       "SELECT y :: DOUBLE AS actual, round(avg(CASE WHEN y = label THEN 1.0 ELSE 0.0 END), 6) AS rate FROM w GROUP BY y")
def fit_and_score(spark, sf):
    parted = P.stratified_split(documents(spark, sf), "row_id", "label")
    _, tables = E.train_classifier(parted, DOC_FEATURES, L.knn, {"n_neighbors": 3})
    seen = tables["confusion"].groupBy("actual").agg(F.sum("n").alias("_n")).where("_n > 0").select("actual")
    return rounded(tables["classes"].join(seen, "actual"))


@query("eva2_benchmark_regressors")
def benchmark_regressors(spark, sf):
    settings = {"SVM (RBF)": {"iterations": 10, "width": 100}, "Random Forest": {"n_estimators": 5, "max_depth": 6}, "XGBoost": {"n_estimators": 5}}
    return rounded(E.benchmark_regressors(P.random_split(parts(spark, sf), "row_id"), PART_FEATURES, settings))


@query("eva3_benchmark_classifiers")
def benchmark_classifiers(spark, sf):
    settings = {"KNN": {"n_neighbors": 5}, "Decision Tree": {"max_depth": 5}, "Random Forest": {"n_estimators": 5, "max_depth": 5},
                "XGBoost": {"n_estimators": 2}, "AdaBoost": {"n_estimators": 3}}
    return rounded(E.benchmark_classifiers(documents(spark, sf), DOC_FEATURES, 2, settings=settings))


@query("eva4_benchmark_balancing")
def benchmark_balancing(spark, sf):
    return rounded(E.benchmark_balancing(documents(spark, sf), DOC_FEATURES, L.decision_tree, {"max_depth": 5}, 3))


@query("cv4_cross_validation")
def cross_validation(spark, sf):
    scores = E.cross_validate(documents(spark, sf), DOC_FEATURES, L.decision_tree, {"max_depth": 5}, 4, "stratified", "accuracy", balance="oversample", name="tree")
    return rounded(M.fold_summary(scores))


@query("cv5_cross_validation_all_metrics")
def cross_validation_all(spark, sf):
    scores = E.cross_validate(parts(spark, sf), PART_FEATURES, L.linear, {}, 3, "kfold", name="linear")
    return rounded(M.fold_summary(scores))


@query("cv3_cross_validation_in_time")
def cross_validation_in_time(spark, sf):
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("row_id"), F.col("o_totalprice").alias("label"), F.col("o_custkey").cast("double").alias("cust"),
                                               F.dayofyear("o_orderdate").cast("double").alias("day"), F.col("o_orderdate").alias("ts"))
    scores = E.cross_validate(orders, ["cust", "day"], L.linear, {}, 3, "timeseries", "neg_mean_absolute_error", ts="ts", name="linear")
    return rounded(M.fold_summary(scores), 2)


@query("opt1_evolutionary_search")
def evolutionary_search(spark, sf):
    space = {"max_depth": ("int", 2, 8), "min_samples_split": ("int", 2, 10)}
    found = E.evolve(documents(spark, sf), DOC_FEATURES, L.decision_tree, space, population=3, generations=1, n_folds=2)
    return found.select("generation", F.col("params")["max_depth"].alias("max_depth"), F.col("params")["min_samples_split"].alias("min_samples_split"), F.round("score", 6).alias("score"))


@query("jn6_parameter_grid",
       "WITH g AS (SELECT d, s FROM (SELECT unnest([2, 4, 8]) AS d), (SELECT unnest([2, 10]) AS s)) "
       "SELECT CAST(d AS INTEGER) AS max_depth, CAST(s AS INTEGER) AS min_rows, count(*) FILTER (n >= s) AS classes FROM g, (SELECT quality, toxic, count(*) AS n FROM labels GROUP BY 1, 2) GROUP BY 1, 2")
def parameter_grid(spark, sf):
    """Grid points ride on every class row as one exploded array."""
    per = labelled(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    grid = F.array(*[F.struct(F.lit(d).alias("max_depth"), F.lit(s).alias("min_rows")) for d in (2, 4, 8) for s in (2, 10)])
    return per.select("n", F.explode(grid).alias("g")).groupBy("g.max_depth", "g.min_rows").agg(F.count_if(F.col("n") >= F.col("g.min_rows")).alias("classes"))


class MeanLearner:
    """A user-supplied learner: predicts the mean label of its training rows."""

    def __init__(self, shift=0.0):
        self.shift, self.value = shift, None

    def fit(self, df):
        model = MeanLearner(self.shift)
        model.value = df.agg(F.avg("label")).first()[0] + self.shift
        return model

    def transform(self, df):
        return df.withColumn("prediction", F.lit(self.value))


_CV = ("WITH y AS (SELECT p_partkey AS row_id, p_retailprice AS label FROM part), " + _PLACED + ", f AS (SELECT label, (pos - 1) % 3 AS fold FROM p), "
       "m AS (SELECT k AS fold, (SELECT avg(label) + 5 FROM f WHERE f.fold <> k) AS guess FROM (SELECT unnest(range(0, 3)) AS k))")


@query("udf3_model_factory", _CV + " SELECT CAST(f.fold AS INTEGER) AS fold, 'neg_mean_absolute_error' AS metric, round(-avg(abs(label - guess)), 6) AS value FROM f JOIN m ON f.fold = m.fold GROUP BY f.fold")
def model_factory(spark, sf):
    scores = E.cross_validate(parts(spark, sf), PART_FEATURES, lambda p: MeanLearner(p["shift"]), {"shift": 5.0}, 3, "kfold", "neg_mean_absolute_error")
    return rounded(scores.select("fold", "metric", "value"))


@query("udf4_scorers_by_name", _W + ", o AS (SELECT sum(tp) / sum(sup) AS a, sum(p * sup) / sum(sup) AS p, sum(r * sup) / sum(sup) AS r, "
       "sum(CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END * sup) / sum(sup) AS f FROM q) "
       "SELECT unnest(['accuracy', 'precision_weighted', 'recall_weighted', 'f1_weighted']) AS scorer, round(unnest([a, p, r, f]), 6) AS value FROM o")
def scorers_by_name(spark, sf):
    df = guessed(spark, sf)
    rows = [(name, M.score(df, "label", "prediction", name)) for name in ("accuracy", "precision_weighted", "recall_weighted", "f1_weighted")]
    return rounded(spark.createDataFrame(rows, "scorer string, value double"))
