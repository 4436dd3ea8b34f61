"""The preparation job: from raw customer rows to a feature table.

``fit`` runs one bounded aggregation per fitted step and keeps literals only;
``apply`` is a chain of projections and filters over a batch or a stream.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowmill.functions.columns import col, is_missing
from rowmill.operators import binning, encode, impute, outliers, project, scale
from rowmill.operators.lookup import Lookup
from rowmill.operators.profile import preparation_summary
from rowmill.operators.rebalance import smote
from rowmill.operators.score import reject_reason
from rowmill.operators.split import split, split_parts
from rowmill.plans.settings import Settings
from rowmill.plans.state import load_state, save_state
from rowmill.sources.readers import read_splits
from rowmill.sources.workdir import new_path, stage
from rowmill.sources.writers import is_complete, save, write_splits

State = dict[str, dict]


def fit_steps(df: DataFrame, s: Settings) -> State:
    """Fitted state of all steps, from rows whose critical columns are present."""
    state: State = {"fill": {}}
    if s.imputer:
        imputer = impute.registered_imputer(s.imputer)
        state["imputer"] = {s.imputer: imputer.fit(df)}
        df = imputer.apply(df, state["imputer"][s.imputer])
    by_method: dict[str, list[str]] = {}
    for c, method in s.fill_methods.items():
        by_method.setdefault(method, []).append(c)
    for method, columns in by_method.items():
        state["fill"].update(impute.fit_fill(df, columns, method))
    out = _fill_literals(df, state, s)

    if s.detection_method == "iqr":
        bounds = outliers.fit_iqr(out, s.outlier_columns, s.iqr_threshold)
    else:
        bounds = outliers.fit_sigma(out, s.outlier_columns, s.sigmas)
    state["outliers"] = {c: list(b) for c, b in bounds.items()}
    out = outlier_steps(out, state, s)

    state["one_hot"] = encode.fit_one_hot(out, s.nominal_columns)
    fit_scaling = scale.fit_min_max if s.scaling == "minmax" else scale.fit_standard
    state["scale"] = {c: list(v) for c, v in fit_scaling(out, s.scale_columns).items()}
    state["bins"] = {
        c: {
            "bins": [[label, list(r)] for label, r in b.items()],
            "exact": [[v, label] for v, label in s.bin_exact.get(c, {}).items()],
            "otherwise": s.bin_otherwise,
        }
        for c, b in s.bins.items()
    }
    state["ordinal"] = {c: dict(m) for c, m in s.ordinal_mappings.items()}
    return state


def fill_steps(df: DataFrame, state: State, s: Settings) -> DataFrame:
    """Own imputer, then literals.  Here and below a step without columns has no
    entry in a stored state."""
    for name, fitted in state.get("imputer", {}).items():
        df = impute.registered_imputer(name).apply(df, fitted)
    return _fill_literals(df, state, s)


def _fill_literals(df: DataFrame, state: State, s: Settings) -> DataFrame:
    out = impute.apply_fill(df, state.get("fill", {}))
    for column, label in s.fill_labels.items():
        if column not in s.predict_labels:
            out = impute.fill_category(out, column, label)
    return out


def outlier_steps(df: DataFrame, state: State, s: Settings) -> DataFrame:
    bounds = {c: tuple(b) for c, b in state.get("outliers", {}).items()}
    return outliers.handle_outliers(
        df, list(bounds), s.outlier_method, s.min_outliers, bounds
    )


def feature_steps(df: DataFrame, state: State) -> DataFrame:
    """Bin, encode and scale with fitted state."""
    out = df
    for c, b in state.get("bins", {}).items():
        out = binning.bin_column(
            out, c, dict(b["bins"]), exact={v: label for v, label in b["exact"]},
            otherwise=b["otherwise"],
        )
    out = encode.apply_one_hot(out, state.get("one_hot", {}))
    out = encode.apply_ordinal(out, state.get("ordinal", {}))
    return scale.apply_scaling(out, {c: tuple(v) for c, v in state.get("scale", {}).items()})


def fit_predictors(df: DataFrame, s: Settings) -> dict[str, dict]:
    """What fills predicted categories: per column its keys, the fallback, and
    the lookup table, as rows or, beyond the bound of a lookup, as a path."""
    fitted = {}
    for column, keys in s.predict_labels.items():
        found = impute.fit_category_predictor(df, keys, column, s.label_domain)
        fitted[column] = {"keys": list(found.keys), "fallback": found.fallback}
        if found.lookup.rows is None:
            path = new_path(df.sparkSession, "predictor")
            stage(found.lookup.table, "predictor", path)
            fitted[column]["path"] = path
        else:
            table = found.lookup.table
            fitted[column]["schema"] = table.schema.simpleString()
            fitted[column]["rows"] = [list(r) for r in table.collect()]
    return fitted


def predict_steps(df: DataFrame, predictors: dict[str, dict]) -> DataFrame:
    """Fill categories that are predicted from other columns."""
    spark = df.sparkSession
    for column, p in predictors.items():
        if "path" in p:
            lookup = Lookup(spark.read.parquet(p["path"]), None)
        else:
            rows = [tuple(r) for r in p["rows"]]
            lookup = Lookup(spark.createDataFrame(rows, p["schema"]), len(rows))
        predictor = impute.CategoryPredictor(tuple(p["keys"]), column, p["fallback"], lookup)
        df = impute.apply_category_predictor(df, predictor)
    return df


def feature_names(state: State, s: Settings, columns: list[str]) -> list[str]:
    """Feature columns in table order: all but key, target, split and dropped."""
    out = [c for c in columns if c not in s.bins and c not in s.nominal_columns]
    out = [c for c in out if c not in {s.key, s.target, "split", *s.drop_columns}]
    derived = [f"{c}Bins" for c in s.bins] + encode.indicator_names(state.get("one_hot", {}))
    return out + [d for d in derived if d not in out]


def prepare(
    df: DataFrame, settings: Settings | None = None, stage_rows: bool = True
) -> tuple[DataFrame, State]:
    """The feature table with key, target and ``split``, and the fitted state.

    By default the rows are split first and statistics come from the training
    part; ``fit_on='all'`` takes them from all rows and splits at the end.
    The rows are written once before anything is fitted, so that the passes
    below read a columnar table; ``stage_rows=False`` reads the source each
    time, which is right when the source is such a table already.
    ``rebalance='smote'`` adds rows to the training part (see ``rebalanced``).
    """
    s = settings or Settings()
    early = s.fit_on == "train"
    rows = project.drop_missing(df, s.critical_columns)

    def dealt(table: DataFrame) -> DataFrame:
        return split(table, s.key, s.target, s.split_method, s.test_size, s.seed)

    if early:
        rows = dealt(rows)
    # a predicted category is learnt as all else is: from the training part
    predictors = fit_predictors(split_parts(rows)[0] if early else rows, s)
    rows = predict_steps(rows, predictors)
    if stage_rows:
        rows = stage(rows, "imputed")
    state = fit_steps(split_parts(rows)[0] if early else rows, s)
    if predictors:
        state["predict"] = predictors
    kept = outlier_steps(fill_steps(rows, state, s), state, s)
    if not early:
        kept = dealt(kept)
    features = feature_names(state, s, df.columns)
    prepared = feature_steps(kept, state).select(
        *[col(c) for c in [s.key, *features, s.target, "split"]]
    )
    if s.rebalance == "smote":
        prepared = rebalanced(prepared, s, features)
    return prepared, state


def rebalanced(prepared: DataFrame, s: Settings, features: Sequence[str]) -> DataFrame:
    """The training part with new rows until its classes are equal, the test
    part as it is; features become doubles.

    A new row has the key of the row it was made from, so that folds by key
    keep the two together, and ``copy`` counts the new rows of a key from 1.
    """
    rows = stage(prepared, "prepared")  # read once per class and part
    train, test = split_parts(rows)
    more = smote(train, s.key, s.target, features, s.neighbors, s.seed, with_key=True)
    same = test.select(
        *[col(s.key), *[col(f).cast("double").alias(f) for f in features], col(s.target)],
        F.lit(0).cast("bigint").alias("copy"),
    )
    return (
        more.drop("synthetic").withColumn("split", F.lit("train"))
        .unionByName(same.withColumn("split", F.lit("test")))
        .select(*[col(c) for c in [s.key, *features, s.target, "copy", "split"]])
    )


def run(
    df: DataFrame,
    path: str,
    settings: Settings | None = None,
    output_format: str = "parquet",
    force_rebuild: bool = True,
) -> tuple[DataFrame, State]:
    """Prepare, write the parts, and return a one-row summary and the state.

    Summary, state and settings are written beside the parts.  With
    ``force_rebuild=False`` a finished output of equal settings and format is
    taken as it is; whether the source has changed since is not looked at.
    """
    s = settings or Settings()
    spark, root = df.sparkSession, path.rstrip("/")
    if not force_rebuild and _prepared_alike(df, root, s, output_format):
        return spark.read.parquet(f"{root}/summary"), load_state(spark, f"{root}/state")
    made_with = "settings string, format string"
    save(spark.createDataFrame([("", "")], made_with), f"{root}/settings")  # not finished
    source = stage(project.drop_missing(df, s.critical_columns), "source")
    prepared, state = prepare(source, s, stage_rows=bool(s.predict_labels))
    write_splits(prepared, path, output_format)
    held = "csv" if output_format == "csv" else "parquet"
    table = read_splits(df.sparkSession, path, held, prepared.schema)
    features = [c for c in prepared.columns if c not in (s.key, s.target, "split", "copy")]
    made = table.filter(F.col("copy") > 0).count() if "copy" in table.columns else 0
    summary = preparation_summary(
        table,
        features,
        source.count() + made,
        {
            "test_size": s.test_size,
            "random_state": s.seed,
            "outlier_method": s.detection_method,
            "scaling": s.scaling,
        },
    )
    summary = spark.createDataFrame(summary.collect(), summary.schema)  # one row
    save_state(spark, state, f"{root}/state")
    save(summary, f"{root}/summary")
    # written last: says that all else is there
    save(spark.createDataFrame([(s.to_json(), output_format)], made_with), f"{root}/settings")
    return summary, state


def _prepared_alike(df: DataFrame, root: str, s: Settings, output_format: str) -> bool:
    spark = df.sparkSession
    if not is_complete(spark, f"{root}/settings"):
        return False
    return tuple(spark.read.parquet(f"{root}/settings").first()) == (s.to_json(), output_format)


def prepare_records(df: DataFrame, state: State, settings: Settings, features: list[str]) -> DataFrame:
    """Records prepared as in training: key and aligned features, no row lost.

    Outlying values are capped if training capped them; where it removed rows,
    records keep theirs, since each is due a score.
    """
    return project.align(_record_steps(df, state, settings), [settings.key, *features])


def _record_steps(df: DataFrame, state: State, s: Settings) -> DataFrame:
    out = fill_steps(predict_steps(df, state.get("predict", {})), state, s)
    if s.outlier_method == "cap":
        out = outlier_steps(out, state, s)
    return feature_steps(out, state)


def split_records(
    df: DataFrame, state: State, settings: Settings, features: list[str], required: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Records that can be scored, and all others with their reason: a required
    value is missing, or a feature is missing after the preparation."""
    held = df.withColumn("_record", F.struct(*[col(c) for c in df.columns]))
    held = held.withColumn("_reason", reject_reason(df, required) if required else F.lit(None).cast("string"))
    prepared = project.align(_record_steps(held, state, settings), ["_record", "_reason", *features])
    absent = F.array_compact(F.array(*[F.when(is_missing(prepared, c), F.lit(c)) for c in features]))
    unprepared = F.when(F.size(absent) > 0, F.concat(F.lit("not prepared: "), F.array_join(absent, ",")))
    marked = prepared.select("_record.*", F.coalesce("_reason", unprepared).alias("reject_reason"))
    good = marked.filter(F.col("reject_reason").isNull()).drop("reject_reason")
    return good, marked.filter(F.col("reject_reason").isNotNull())
