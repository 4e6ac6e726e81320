"""Model queries (M8-M13, M21, M22, M23 with the fitted model, K2). Model outputs have no SQL twin;
the queries named facts, and S11 and M23, return what must hold for any sound fit."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import functions as F

from waitcast.operators import blend as B
from waitcast.operators import boosting as BO
from waitcast.operators import cascade as CA
from waitcast.operators import encode as E
from waitcast.operators import explore as X
from waitcast.operators import history as H
from waitcast.operators import model as MD
from waitcast.operators import neighbours as N
from waitcast.plans import scoring as S
from waitcast.plans import training as TR
from waitcast.operators.scalars import with_scalars
from waitcast.plans.catalog import query, rounded
from waitcast.plans.queries_history import SPLIT_SQL
from waitcast.session import spread
from waitcast.sources import tables as tb

FEATURED = "1-URGENT"


def _split(spark, sf):
    """Train rows prepared as training data (median hour fill), test rows as requests."""
    raw_tr, raw_te = E.hash_split(spread(tb.readings_orders(spark, sf)), "row_id")
    return S.prepare_training(raw_tr).checkpoint(eager=True), S.prepare_requests(raw_te)


def _features(spark, sf):
    """Train rows, features of train and test rows, and their columns. What features take from the train rows is fitted once for both."""
    tr, te = _split(spark, sf)
    fitted = TR.materialised(TR.fit_features(tr, FEATURED))
    ftr, fte = (TR.apply_features(d, fitted, FEATURED) for d in (tr, te))
    return tr, ftr, fte, TR.feature_columns(ftr)


@query("m8_vector_assembly")
def m8(spark, sf):
    """M8: every numeric feature of the test rows assembled into one vector."""
    _, _, fte, cols = _features(spark, sf)
    v = MD.assembler(cols).transform(fte)
    return MD.as_array(v, "features_raw").select("row_id", F.size("features_raw").alias("n_features"), "features_raw")


@query("m9_standard_scaling")
def m9(spark, sf):
    """M9: scaler fitted on train rows (centred, unit variance), applied to test rows."""
    _, ftr, fte, cols = _features(spark, sf)
    a = MD.assembler(cols)
    sc = MD.scaler().fit(a.transform(ftr))
    return MD.as_array(sc.transform(a.transform(fte)), "features").select("row_id", "features")


_NUMBERS = ["mes", "dia_semana_num", "temperatura", "humedad", "codigo_clima"]
_NUMBERS_SQL = "(select row_id, tiempo_espera, month(fecha) mes, isodow(fecha) - 1 dia_semana_num, temperatura, humedad, codigo_clima from @RO)"


def _number_rows(spark, sf):
    rows = tb.readings_orders(spark, sf).withColumns({"mes": F.month("fecha"), "dia_semana_num": F.weekday("fecha")})
    return E.hash_split(rows, "row_id")


def _entries(array):
    """The entries of a feature array as columns again, NaN as NULL."""
    return [F.nanvl(F.element_at(array, i), F.lit(None).cast("double")).alias(c) for i, c in enumerate(_NUMBERS, 1)]


@query("m8_vector_entries", f"select row_id, {len(_NUMBERS)} n_features, {', '.join(f'cast({c} as double) {c}' for c in _NUMBERS)} "
       f"from {_NUMBERS_SQL} where not ({SPLIT_SQL})")
def m8e(spark, sf):
    """M8: calendar and weather numbers of the test rows assembled into a vector; its entries, NULL where the input is."""
    _, te = _number_rows(spark, sf)
    v = MD.as_array(MD.assembler(_NUMBERS).transform(te.select("row_id", *_NUMBERS)), "features_raw")
    return rounded(v.select("row_id", F.size("features_raw").alias("n_features"), *_entries("features_raw")))


@query("m9_scaled_entries", f"with n as (select row_id, {', '.join(f'coalesce({c}, 0) {c}' for c in _NUMBERS)} from {_NUMBERS_SQL}), "
       f"s as (select {', '.join(f'avg({c}) a_{c}, stddev_samp({c}) s_{c}' for c in _NUMBERS)} from n where {SPLIT_SQL}) "
       f"select row_id, {', '.join(f'round(({c} - a_{c}) / s_{c}, 6) {c}' for c in _NUMBERS)} from n, s where not ({SPLIT_SQL})")
def m9e(spark, sf):
    """M9: the same numbers, 0 where unknown, centred and scaled by mean and sample deviation of the train rows."""
    tr, te = (MD.assembler(_NUMBERS).transform(d.select("row_id", *_NUMBERS).fillna(0)) for d in _number_rows(spark, sf))
    v = MD.as_array(MD.scaler().fit(tr).transform(te), "features")
    return rounded(v.select("row_id", *_entries("features")))


def _gbt(spark, sf):
    """Model, test features and columns; fitted anew for each query that asks."""
    _, ftr, fte, cols = _features(spark, sf)
    return TR.fitted_gbt(spark, ftr, cols), fte, cols


@query("m10_gbt_regressor")
def m10(spark, sf):
    """GBT pipeline (100 iterations, depth 8, step 0.05, seed 42) fitted on train rows;
    test predictions with their residuals (M24)."""
    model, fte, _ = _gbt(spark, sf)
    p = model.transform(fte).select("row_id", F.col("tiempo_espera").alias("y"), F.col("pred_base").alias("pred"))
    return rounded(p.withColumn("residual", F.col("y") - F.col("pred")))


@query("m10_gbt_test_metrics")
def m10m(spark, sf):
    """M14/M15 on the fitted GBT's test predictions."""
    from waitcast.operators.metrics import regression_metrics
    model, fte, _ = _gbt(spark, sf)
    p = model.transform(fte).select(F.col("tiempo_espera").alias("y"), F.col("pred_base").alias("pred"))
    return rounded(regression_metrics(p))


@query("m10_gbt_facts", f"select count(tiempo_espera) n, true beats_the_mean, true finite from @RO where {SPLIT_SQL}")
def m10f(spark, sf):
    """What any sound fit must show on the rows it was fitted on: a finite prediction for every row, and an
    error below that of their mean."""
    tr, ftr, _, cols = _features(spark, sf)
    ftr = spread(ftr.select(*cols, "tiempo_espera"))  # fitted on and predicted
    model = TR.fitted_gbt(spark, ftr, cols, held=True)
    p = model.transform(ftr).select(F.col("tiempo_espera").alias("y"), F.col("pred_base").alias("pred")).where("y IS NOT NULL")
    p = with_scalars(p, tr.agg(F.avg("tiempo_espera").alias("mean")))
    return p.agg(F.count("pred").alias("n"), (F.avg(F.pow(F.col("y") - F.col("pred"), 2)) < F.avg(F.pow(F.col("y") - F.col("mean"), 2))).alias("beats_the_mean"),
                 F.every(~F.isnan("pred") & (F.abs("pred") < 1e9)).alias("finite"))


@query("m11_gbt_configurations", f"select unnest(['spark_100_005_8', 'xgb_1000_005_8', 'xgb_1500_002_10', 'xgb_500_01_6', 'xgb_500_01_8']) config, "
       f"(select count(*) from @RO where not ({SPLIT_SQL})) n, true finite")
def m11(spark, sf):
    """Each boosted-tree configuration fitted with all its trees (100 to 1,500) and applied to the held-out rows."""
    _, ftr, fte, cols = _features(spark, sf)
    ftr, fte = spread(ftr.select(*cols, "tiempo_espera")), fte.select(*cols).checkpoint(eager=True)  # all configurations go over them
    configs = sorted(MD.GBT_CONFIGS)
    # side by side: on small tables a fit is one task, on large ones a job a level leaves cores idle between jobs
    with ThreadPoolExecutor(len(configs)) as pool:
        models = list(pool.map(inheritable_thread_target(spark)(lambda config: TR.fitted_gbt(spark, ftr, cols, config, held=True)), configs))
    out = None
    for config, model in zip(configs, models, strict=True):
        p = model.transform(fte)
        one = p.agg(F.count("pred_base").alias("n"), F.every(F.abs("pred_base") < 1e9).alias("finite")).withColumn("config", F.lit(config))
        out = one if out is None else out.unionByName(one)
    return out.select("config", "n", "finite")


_INNER_SQL = "((((row_id + 7919) % 2147483648) * 2654435761) % 4294967296 < 0.8 * 4294967296)"


@query("m1_validated_fit", f"select count(*) filter (where {_INNER_SQL}) n_fit, count(*) filter (where not {_INNER_SQL}) n_validation, true beats_the_mean, "
       f"true last_is_least, true fewer_than_asked from @RO where {SPLIT_SQL} and tiempo_espera is not null")
def m1v(spark, sf):
    """M1 nested split: boosted trees (500 at most, depth 6, step 0.1) fitted against a validation fifth of the train rows. The loss on it
    is below that of the fitted part's mean, the kept trees end at the least loss, and the fit stopped before its limit."""
    tr, ftr, _, cols = _features(spark, sf)
    model, curve = MD.fit_validated(spark, ftr, cols, "row_id", MD.gbt("xgb_500_01_6"))
    inner = tr.withColumn("fit", E.hash_split_flag("row_id", 0.8, seed=7919))
    y = F.col("tiempo_espera")
    inner = with_scalars(inner, inner.where("fit").agg(F.avg(y).alias("mean")))
    sizes = inner.agg(F.sum(F.col("fit").cast("int")).alias("n_fit"), F.sum((~F.col("fit")).cast("int")).alias("n_validation"),
                      F.avg(F.when(~F.col("fit"), F.pow(y - F.col("mean"), 2))).alias("of_mean"))
    ends = curve.agg(F.min("loss_validation").alias("least"), F.max_by("loss_validation", "trees").alias("last"), F.max("trees").alias("trees"))
    both = with_scalars(sizes, ends)
    return both.select("n_fit", "n_validation", (F.col("least") < F.col("of_mean")).alias("beats_the_mean"),
                       (F.col("last") == F.col("least")).alias("last_is_least"), (F.col("trees") < 500).alias("fewer_than_asked"))


@query("m11_regularised_boosting", f"with t as (select tiempo_espera y, {_INNER_SQL} fit from @RO where {SPLIT_SQL} and tiempo_espera is not null), "
       "m as (select avg(y) mean from t where fit) select count(*) filter (where fit) n_fit, count(*) filter (where not fit) n_validation, "
       "round(avg(power(y - mean, 2)) filter (where fit), 2) fit_loss_of_mean, round(avg(power(y - mean, 2)) filter (where not fit), 2) validation_loss_of_mean, "
       "true fit_loss_falls, true kept_up_to_the_least, true leaves_heavy_enough from t, m")
def m11r(spark, sf):
    """Boosted trees with L1, L2, gamma and row and column sampling (step 0.05, depth 8, 1,000 trees at most) on the calendar and weather
    numbers, NULL where unknown, and the ride's mean wait of the train rows but a validation fifth, ended when three trees bring no
    smaller loss on that fifth. The losses without a tree are those of the mean, those on the fitted rows fall, the trees
    kept end at the least loss, and every leaf holds the rows that the configuration asks for."""
    tr, _ = _number_rows(spark, sf)
    config = BO.CONFIGS["xgb_1000_005_8"]
    fit = E.hash_split_flag("row_id", 0.8, seed=7919)
    rows = E.target_mean_encoding(tr, tr.where(fit), "atraccion").withColumn("fit", fit)
    model = BO.fit(rows, [*_NUMBERS, "atraccion_enc"], "tiempo_espera", "row_id", config, validation=~F.col("fit"), patience=3)
    sizes = rows.where(F.col("tiempo_espera").isNotNull()).agg(F.sum(F.col("fit").cast("int")).alias("n_fit"), F.sum((~F.col("fit")).cast("int")).alias("n_validation"))
    fitted, held_out = ([x[i] for x in model.losses] for i in (1, 2))
    heavy = all(bool((t.n[(t.feature < 0) & (t.n > 0)] >= config.least_weight).all()) for t in model.trees)
    return sizes.select("n_fit", "n_validation", F.round(F.lit(fitted[0]), 2).alias("fit_loss_of_mean"), F.round(F.lit(held_out[0]), 2).alias("validation_loss_of_mean"),
                        F.lit(fitted[-1] < fitted[0]).alias("fit_loss_falls"), F.lit(held_out[len(model.trees)] == min(held_out)).alias("kept_up_to_the_least"),
                        F.lit(heavy).alias("leaves_heavy_enough"))


@query("m12_random_forest_classes")
def m12(spark, sf):
    """Random forest (300 trees, depth 10) on class representative minutes (10/30/60);
    test predictions binned back to classes (F16 bins)."""
    from waitcast.functions.labels import wait_class_bins
    _, ftr, fte, cols = _features(spark, sf)
    ftr = MD.class_targets(ftr)
    model = MD.fit_pipeline(spark, ftr, cols, MD.random_forest())
    p = model.transform(MD.class_targets(fte))
    return rounded(p.select("row_id", "clase", "clase_min", F.col("pred_base").alias("pred"),
                            wait_class_bins("pred_base").alias("clase_pred")))


@query("m12_forest_class_metrics")
def m12m(spark, sf):
    """M18 on the fitted forest: accuracy, macro precision, recall and F1, and kappa of its classes on the held-out rows."""
    from waitcast.operators.metrics import classification_metrics
    p = m12(spark, sf).where("clase IS NOT NULL AND clase_pred IS NOT NULL")
    counts = p.groupBy(F.col("clase").alias("actual"), F.col("clase_pred").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    return rounded(classification_metrics(counts.checkpoint(eager=True)))


@query("m13_class_balancing", """
with o as (select * from @RO),
c as (select row_id, case when tiempo_espera between 5 and 15 then 'Corto' when tiempo_espera > 15 and tiempo_espera <= 45
                          then 'Medio' else 'Largo' end clase
      from o where ((row_id % 2147483648) * 2654435761) % 4294967296 < 0.8 * 4294967296 and tiempo_espera is not null),
cnt as (select clase, count(*) nc from c group by clase), mx as (select max(nc) nmax from cnt),
r as (select c.row_id, c.clase, cast(nmax as double) / nc r from c join cnt using (clase) cross join mx),
cp as (select clase, greatest(cast(floor(r) as integer) + cast(((((row_id + 104729) % 2147483648) * 2654435761) % 4294967296)
                     / 4294967296.0 < r - floor(r) as integer), 1) copies from r)
select clase, count(*) n_original, sum(copies) n_balanced, sum(copies - 1) n_synthetic from cp group by clase""")
def m13(spark, sf):
    """Class counts before and after oversampling the train rows."""
    tr, _ = _split(spark, sf)
    t = MD.class_targets(tr)
    bal = MD.balance_classes(t, "row_id")
    before = t.groupBy("clase").agg(F.count(F.lit(1)).alias("n_original"))
    after = bal.groupBy("clase").agg(F.count(F.lit(1)).alias("n_balanced"),
                                     F.sum(F.col("synthetic").cast("int")).alias("n_synthetic"))
    return before.join(after, "clase")


_NEAR = {"humedad": 16.0, "temperatura": 8.0, "codigo_clima": 1.0, "mes": 2.0, "dia_semana_num": 2.0}
_NEAR_SQL = f"""
t as (select row_id, case when tiempo_espera between 5 and 15 then 'Corto' when tiempo_espera > 15 and tiempo_espera <= 45
                          then 'Medio' else 'Largo' end clase, temperatura,
             humedad / 16 f0, temperatura / 8 f1, codigo_clima / 1 f2, month(fecha) / 2 f3, (isodow(fecha) - 1) / 2 f4
      from @RO where {SPLIT_SQL} and tiempo_espera is not null)"""


def _near_rows(spark, sf):
    tr, _ = E.hash_split(tb.readings_orders(spark, sf).where("tiempo_espera IS NOT NULL"), "row_id")
    return MD.class_targets(tr.withColumns({"mes": F.month("fecha"), "dia_semana_num": F.weekday("fecha")}))


@query("m13_class_neighbours", f"""
with {_NEAR_SQL},
p as (select clase, f0, f1, f2, f3, f4, min(row_id) row_id from t where temperatura is not null group by all),
d as (select a.clase, a.row_id, min({{'d': (((a.f0 - b.f0) * (a.f0 - b.f0) + (a.f1 - b.f1) * (a.f1 - b.f1)) + (a.f2 - b.f2) * (a.f2 - b.f2)
        + (a.f3 - b.f3) * (a.f3 - b.f3)) + (a.f4 - b.f4) * (a.f4 - b.f4), 'o': b.row_id}}, 5) near
      from p a join p b on a.clase = b.clase and a.row_id <> b.row_id group by all),
u as (select clase, row_id, unnest(near) e, generate_subscripts(near, 1) rank from d)
select clase, row_id, rank, e.o neighbour, round(e.d, 6) distance2 from u""")
def m13n(spark, sf):
    """The five nearest in-class positions of every position of the train rows, by weather and calendar."""
    return rounded(N.class_neighbours(_near_rows(spark, sf), "row_id", "clase", list(_NEAR), scale=list(_NEAR.values())))


@query("m13_neighbour_balancing", f"""
with {_NEAR_SQL},
cnt as (select clase, count(*) nc from t group by clase), mx as (select max(nc) nmax from cnt),
r as (select t.*, cast(nmax as double) / nc r from t join cnt using (clase) cross join mx),
cp as (select clase, temperatura, greatest(cast(floor(r) as integer) + cast(((((row_id + 104729) % 2147483648) * 2654435761) % 4294967296)
                     / 4294967296.0 < r - floor(r) as integer), 1) copies from r)
select clase, count(*) n_original, sum(copies) n_balanced, coalesce(sum(copies - 1) filter (where temperatura is not null), 0) n_between from cp group by clase""")
def m13b(spark, sf):
    """Class sizes before and after balancing by interpolation; n_between counts the synthetic rows whose every feature lies
    between the base row's and the neighbour's."""
    rows = _near_rows(spark, sf)
    made = N.balance_by_neighbours(rows, "row_id", "clase", list(_NEAR), scale=list(_NEAR.values()))
    known = rows.select("row_id", *[F.col(c).alias(f"base_{c}") for c in _NEAR])
    ends = rows.select(F.col("row_id").alias("neighbour"), *[F.col(c).alias(f"end_{c}") for c in _NEAR])
    both = made.join(known, "row_id").join(ends, "neighbour", "left")
    between = F.col("synthetic") > 0
    for c in _NEAR:
        between = between & F.col(c).between(F.least(f"base_{c}", f"end_{c}"), F.greatest(f"base_{c}", f"end_{c}")) & F.col(f"end_{c}").isNotNull()
    return both.groupBy("clase").agg(F.sum((F.col("synthetic") == 0).cast("int")).alias("n_original"), F.count(F.lit(1)).alias("n_balanced"),
                                     F.sum(F.coalesce(between, F.lit(False)).cast("int")).alias("n_between"))


@query("m21_feature_importances")
def m21(spark, sf):
    """Importance of every feature of the fitted GBT."""
    model, _, cols = _gbt(spark, sf)
    return rounded(MD.importances(spark, model, cols))


@query("m21_importance_facts", "select true sums_to_one, true none_negative")
def m21f(spark, sf):
    """Importances are shares of one."""
    model, _, cols = _gbt(spark, sf)
    imp = MD.importances(spark, model, cols)
    return imp.agg((F.abs(F.sum("importance") - 1) < 1e-6).alias("sums_to_one"), F.every(F.col("importance") >= 0).alias("none_negative"))


@query("k2_top_feature_importances")
def k2(spark, sf):
    """K2: the 15 most important features (top-k report)."""
    model, _, cols = _gbt(spark, sf)
    imp = rounded(MD.importances(spark, model, cols))
    return X.top_k(imp, [F.desc("importance"), F.asc("feature")], 15)


@query("m22_align_columns")
def m22(spark, sf):
    """Request features aligned to the training column list and order; columns the
    requests lack are filled by family rule or 0."""
    tr, ftr, _, cols = _features(spark, sf)
    o = tb.readings_orders(spark, sf).drop("tiempo_espera", "temperatura")
    req = S.prepare_requests(o)
    freq = TR.build_features(req.withColumn("temperatura", F.lit(None).cast("double")), tr, FEATURED)
    freq = freq.drop("count_mes", "mean_hora", "p90_dia")  # a request table missing some columns
    g = H.global_stats(tr).select("mean", "median", "std", "p75", "p90", "p95")
    return MD.align_columns(freq.select("row_id", *[c for c in freq.columns if c in cols]), cols, g)


@query("m22_aligned_requests", f"""
with t as (select avg(tiempo_espera) mean, median(tiempo_espera) median, quantile_cont(tiempo_espera, 0.9) p90 from {_NUMBERS_SQL} where {SPLIT_SQL})
select row_id, humedad, round(mean, 6) mean_hora, temperatura, cast(0 as double) count_mes, round(p90, 6) p90_dia, cast(0 as double) franja,
       round(median, 6) median_atraccion from {_NUMBERS_SQL}, t where not ({SPLIT_SQL})""")
def m22a(spark, sf):
    """Requests with two of seven training columns, in another order, aligned to them: counts and unknown families 0, other history
    columns by their family's global statistic of the train rows; columns the model does not know stay ahead."""
    tr, te = _number_rows(spark, sf)
    cols = ["humedad", "mean_hora", "temperatura", "count_mes", "p90_dia", "franja", "median_atraccion"]
    g = H.global_stats(tr).select("mean", "median", "std", "p75", "p90", "p95")
    out = MD.align_columns(te.select("temperatura", "row_id", "humedad"), cols, g)
    if out.columns != ["row_id", *cols]:
        raise ValueError(f"columns out of order: {out.columns}")
    return rounded(out)


@query("m23_batch_scoring_gbt")
def m23(spark, sf):
    """Requests -> features -> fitted GBT -> cascade -> blend -> ladder -> result record."""
    tr, _ = _split(spark, sf)
    model, _, _ = _gbt(spark, sf)
    o = tb.readings_orders(spark, sf).drop("tiempo_espera")
    req = S.prepare_requests(o)
    feats = TR.build_features(req, tr, FEATURED)
    pred = model.transform(feats).select("row_id", "pred_base")
    base = req.join(pred, "row_id")
    c = CA.cascade(base, S.materialized_histories(tr))
    out = B.calendar_ladder(B.history_base(c), featured=FEATURED)
    return rounded(B.result_record(out, keep=["row_id"], featured=FEATURED))


@query("s11_pipeline_persist", f"select row_id, true same from @RO where not ({SPLIT_SQL})")
def s11(spark, sf):
    """The fitted GBT pipeline saved with the MLlib writer into the shared checkpoint
    folder, loaded back, and used to score the test rows; ``same`` compares with the
    in-memory model's prediction."""
    from waitcast.sources import files as FS
    model, fte, cols = _gbt(spark, sf)
    path = FS.staging_dir(spark, "pipeline")
    FS.save_pipeline(model, path)
    loaded = FS.load_pipeline(path)
    fte = fte.select("row_id", *cols).checkpoint(eager=True)  # scored by both
    a = model.transform(fte).select("row_id", F.col("pred_base").alias("pred_mem"))
    b = loaded.transform(fte).select("row_id", F.col("pred_base").alias("pred_loaded"))
    return a.join(b, "row_id").select("row_id", (F.col("pred_mem") == F.col("pred_loaded")).alias("same"))


@query("m23_train_save_score", "select row_id, true in_bounds, true same from @RO")
def m23_artifacts(spark, sf):
    """Training job -> a published version of the artifacts -> a separate serving job that reads only that version and scores
    every orders row: each row once, within the bounds of the clamp; ``same``: with the prediction of the saved pipeline on features
    fitted on the training rows themselves."""
    from waitcast.sources import artifacts as A
    from waitcast.sources import files as FS
    root = FS.staging_dir(spark, "artifacts")
    TR.run_training(spark, tb.readings_orders(spark, sf), root, FEATURED).collect()
    orders = tb.readings_orders(spark, sf).drop("tiempo_espera")
    served = S.score_from_artifacts(spark, orders, root, FEATURED)
    out = B.result_record(served, keep=["row_id"], featured=FEATURED).select("row_id", F.col("minutos_predichos").between(5, 180).alias("in_bounds"))
    tr, _ = _split(spark, sf)
    feats = TR.build_features(S.prepare_requests(orders), tr, FEATURED, serving=True)
    direct = A.open_version(spark, root).pipeline("pipeline").transform(feats).select("row_id", F.col("pred_base").alias("direct"))
    both = served.select("row_id", "pred_base").join(direct, "row_id").select("row_id", (F.abs(F.col("pred_base") - F.col("direct")) < 1e-6).alias("same"))
    return out.join(both, "row_id")
