"""Scoring and training pipelines (survey N3, N4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions import expr as B
from ..functions.contract import conform_to_contract, map_output_columns
from ..operators import audit as A
from ..operators import decision as D
from ..operators import features as X
from ..operators import iv as V_IV
from ..operators import merge as M
from ..operators import model as K
from ..operators.classification import classification_metrics
from ..roles import DEFAULT_ROLES
from ..session import cut_lineage, written
from ..sources import versioned as V
from ..sources.sinks import export_report
from ..sources.tables import load_for_scoring, load_training

PRED_KEYS = ["AFILIADO_RUT", "LCC_COMCOR"]
STICKY = ["SEMAFORO", "PROBABILIDAD_APROBACION", "UMBRAL_VERDE", "UMBRAL_AMARILLO", "FECHA_PROCESAMIENTO",
          "FECHA_DESDE", "FECHA_HASTA", "MODELO_VERSION", "GLOSA_GENERADA", "CAUSAL_GENERADA"]


def _thresholds(decided: DataFrame, optimise: bool, label: str, prior: str | None, review, rate,
                fixed=D.FIXED_DAILY, grid=D.GRID_DAILY) -> tuple[Column, Column]:
    """Green / yellow thresholds as scalar-subquery columns (fixed values when
    optimisation is off or there is no decided row in the population)."""
    fg, fy = F.lit(fixed[0] / 1000), F.lit(fixed[1] / 1000)
    if not optimise:
        return fg, fy
    pop = (F.col(prior) == 0) if prior and prior in decided.columns else None
    best = D.optimise_two_thresholds(decided, label=label, review=review, reversal_rate=rate, grid=grid,
                                     population=pop)
    s = best.select(F.struct("UMBRAL_VERDE", "UMBRAL_AMARILLO").alias("t")).scalar()
    return F.coalesce(s.getField("UMBRAL_VERDE"), fg), F.coalesce(s.getField("UMBRAL_AMARILLO"), fy)


def score_and_publish(train_table: DataFrame, model: PipelineModel, feature_model: X.FeatureModel | None,
                      features: Sequence[str], as_of, date_from=None, date_to=None, label: str = "TARGET_FT3",
                      prior: str | None = "LEAK_FT", keys: Sequence[str] = PRED_KEYS, optimise: bool = True,
                      review=5000, rate=0.0, predictions: DataFrame | None = None,
                      contract: StructType | tuple | None = None, model_version: str = "v1",
                      publish_path: str | None = None) -> dict[str, DataFrame]:
    """Load -> split decided / pending -> features -> score -> thresholds ->
    lights -> contract -> first-write-wins merge -> report.

    ``contract`` is a StructType or (StructType, text limits), e.g.
    ``functions.contract.predictions_contract()``.  With ``publish_path`` the
    predictions are merged into the versioned table there (created by the
    first run) and published whole; ``merged`` is then that table."""
    rows = load_for_scoring(train_table, as_of, date_from, date_to)
    decided, pending = B.split_decided_pending(rows, label)
    date_cols = [c for c in (feature_model.dates if feature_model else []) if c in rows.columns]
    pending = B.neutralise_all_null_dates(pending, decided, date_cols)

    extra = [c for c in (label, prior, "DIASSOLICITADO", "EPISODIO_ACUM_DIAS", "CIE_GRUPO") if c and c in rows.columns]

    def scored(df):
        # the decision columns ride along with the features (renamed so the
        # transforms leave them untouched): no join back on the keys
        carry = df.select("*", *[F.col(c).alias(f"__keep_{c}") for c in extra])
        x = feature_model.transform(carry) if feature_model else carry
        x = X.align_features(x, features, keep=[c for c in keys if c in x.columns] + [f"__keep_{c}" for c in extra])
        s = K.score(model, x, keys, keep=[f"__keep_{c}" for c in extra])
        return s.select(*keys, "PROBABILIDAD_APROBACION", "PREDICCION",
                        *[F.col(f"__keep_{c}").alias(c) for c in extra])

    sd, sp = scored(decided), scored(pending)
    # the scores feed the threshold search, the lights, the merge with its
    # key check and the report: materialise them once (reliable checkpoint
    # in the shared folder)
    sd, sp = cut_lineage(sd), cut_lineage(sp)
    g, y = _thresholds(sd, optimise, label, prior, review, rate)
    sd = D.assign_light(sd, g, y, prior_col=prior).withColumn("ES_PENDIENTE", F.lit(0))
    sp = D.assign_light(sp, g, y, prior_col=prior).withColumn("ES_PENDIENTE", F.lit(1))
    out = sd.unionByName(sp, allowMissingColumns=True).withColumns({
        "UMBRAL_VERDE": g, "UMBRAL_AMARILLO": y,
        "GLOSA_GENERADA": D.decision_text(F.col("SEMAFORO")), "CAUSAL_GENERADA": F.lit(""),
        "FECHA_PROCESAMIENTO": F.lit(as_of).cast("timestamp"),
        "FECHA_DESDE": F.lit(date_from).cast("timestamp"), "FECHA_HASTA": F.lit(date_to).cast("timestamp"),
        "MODELO_VERSION": F.lit(model_version)})
    out = map_output_columns(out)
    if contract is not None:
        schema, limits = contract if isinstance(contract, tuple) else (contract, None)
        out = conform_to_contract(out, schema, limits)
    merged = None
    if predictions is not None:
        upd = [c for c in out.columns if c not in STICKY and c not in keys]
        merged = M.merge_first_write_wins(predictions, out.select(*[c for c in predictions.columns if c in out.columns]),
                                          keys, [c for c in STICKY if c in predictions.columns],
                                          [c for c in upd if c in predictions.columns])
    if publish_path is not None:
        spark = out.sparkSession
        upd = [c for c in out.columns if c not in STICKY and c not in keys]
        V.upsert(spark, publish_path, out, keys, merge=M.merge_first_write_wins,
                 sticky_cols=[c for c in STICKY if c in out.columns], update_cols=upd)
        merged = V.read(spark, publish_path)
    report = D.report_summary(out.where("ES_PENDIENTE = 0"), out.where("ES_PENDIENTE = 1"), g, y,
                              label=label) if label in out.columns else None
    return {"predictions": out, "merged": merged, "report": report}


def report_set(decided: DataFrame, pending: DataFrame, green, yellow, path: str | None = None, label: str = "TARGET_FT3",
               keys: Sequence[str] = PRED_KEYS) -> dict[str, DataFrame]:
    """The frames of a run's report, and with ``path`` also their CSV folders (A11): summary (D10), lights (D7),
    check of the green zone (D8), most frequent green groups (F3), review queue (F2), green list and false positives (F4).

    Summaries of a few rows become one file each, lists as many as they have tasks.
    """
    both = decided.withColumn("GRUPO", F.lit("CON_DICTAMEN")).unionByName(pending.withColumn("GRUPO", F.lit("PENDIENTE")), allowMissingColumns=True)
    frames = {
        "resumen": D.report_summary(decided, pending, green, yellow, label=label), "distribucion": D.light_distribution(both),
        "validacion_verde": D.green_zone_validation(decided, label=label), "cola_revision": D.review_queue(pending, keys=keys),
        "lista_verde": D.green_list(pending), "falsos_positivos": D.false_positive_list(decided, label=label),
    }
    if "CIE_GRUPO" in both.columns:
        frames["grupos_verde"] = D.top_groups_in_green(both)
    if path is not None:
        export_report(frames, path, single_file=["resumen", "distribucion", "validacion_verde", "grupos_verde"])
    return frames


def train_and_audit(table: DataFrame, target: str, feature_model: X.FeatureModel, keys: Sequence[str],
                    test: float = 0.2, seed: int = 42, positive_weight: float = K.POSITIVE_WEIGHT,
                    params: dict | None = None, validation: float = 0.1, protected: str | None = None,
                    roles=DEFAULT_ROLES, group_mode: str | None = "strict",
                    tune_trials: int = 0, tune_options: dict | None = None) -> dict:
    """Load (A2) -> IV table (J3) -> split (fit transforms on train only) ->
    features -> tuning (K3, ``tune_trials`` > 0) -> train (K2) -> score ->
    metrics -> audit.

    The model and its transforms are fitted on the whole training split; IV,
    scores, metrics and audits are of all rows.
    """
    data = load_training(table, target, roles, group_mode=group_mode)
    data = data.select(*data.columns, *[F.col(c) for c in [*keys, *([protected] if protected else [])] if c not in data.columns])
    cats = [c for c in feature_model.categorical if c in data.columns]
    nums = [c for c in feature_model.numeric if c in data.columns]
    woe = None
    for part in ([V_IV.woe_categorical(data, cats, target)] if cats else []) + ([V_IV.woe_numeric(data, nums, target)] if nums else []):
        woe = part if woe is None else woe.unionByName(part)
    iv = V_IV.iv_table(woe, all_features=[*cats, *nums]) if woe is not None else None
    split = K.stratified_split(data, target, keys, test, seed)
    train, hold = split.where("SPLIT = 'train'").drop("SPLIT"), split.where("SPLIT = 'test'").drop("SPLIT")
    # every step of the transforms' fit reads the training rows: split them once
    train = written(train, "train")
    xt = feature_model.fit_transform(train, exclude=[target, *keys])
    feats = [c for c in feature_model.feature_names if c not in keys and c != target and c in feature_model.numeric_names(xt)]
    # training iterates over the features and the drift audit reads them
    # again: compute the transforms once
    xt = written(xt.select(*keys, target, *feats), "features")
    trials = None
    if tune_trials:
        best, trials = K.tune(xt, feats, target, keys, n_trials=tune_trials, seed=seed, **(tune_options or {}))
        params = {**(params or {}), **best}
    fit = xt
    if validation:
        fit = K.stratified_split(xt, target, keys, validation, seed + 1, split_col="__part")
        fit = written(fit.select(target, *feats, (F.col("__part") == "test").alias("__is_val")), "fit")
    model = K.train_classifier(fit, feats, target, positive_weight, "__is_val" if validation else None, params, kept=True)
    carry = [target] + ([protected] if protected else [])
    h2 = hold.select("*", *[F.col(c).alias(f"__keep_{c}") for c in carry]).drop(target)
    xh = X.align_features(feature_model.transform(h2), feats, keep=list(keys) + [f"__keep_{c}" for c in carry])
    scored = cut_lineage(K.score(model, xh, keys, keep=[f"__keep_{c}" for c in carry])
                         .select(*keys, "PROBABILIDAD_APROBACION", "PREDICCION", *[F.col(f"__keep_{c}").alias(c) for c in carry]))
    xh = xh.drop(*[f"__keep_{c}" for c in carry])
    metrics = classification_metrics(scored, "PROBABILIDAD_APROBACION", target)
    perf = A.performance_audit(scored, "PROBABILIDAD_APROBACION", target)
    fair = A.fairness_audit(scored, protected, target, "PREDICCION") if protected else None
    drift = A.drift_ks(xt.select(*feats), xh.select(*feats), feats) if feats else None
    summary = A.audit_summary(A.quality_issues(A.missing_profile(train)), perf, fair,
                              A.drift_summary(drift) if drift is not None else None)
    return {"model": model, "features": feats, "scored": scored, "metrics": metrics, "performance": perf,
            "fairness": fair, "drift": drift, "summary": summary, "iv": iv, "trials": trials,
            "importance": K.feature_importance(model, feats)}
