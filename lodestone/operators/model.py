"""Binary classifier: index, encode, assemble, fit, tune, score.

Fits are Spark MLlib's distributed aggregations; nothing comes to the driver but
coefficients and one row a partition or fold. Category dictionaries are tables
(any number of values), features are computed once for all fits, folds follow
the row's id, and metrics are exact.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import OneHotEncoder, OneHotEncoderModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestone.functions.sampling import hash_fraction, hash_key
from lodestone.session import ship_package
from lodestone.sources.shared import shared_path, write_shared

# The reference's model and tuning settings.
REG_PARAM = 1.0
GRID_REG_PARAM = (0.01, 0.5, 2.0)
GRID_ELASTIC_NET = (0.0, 0.5, 1.0)
NUM_FOLDS = 3
PARALLELISM = 4
SPLIT = (0.8, 0.2)
SPLIT_SEED = 42


# --- splits and folds ----------------------------------------------------------

def random_split(df: DataFrame, weights=SPLIT, seed: int = SPLIT_SEED) -> list[DataFrame]:
    """T7 as the reference does it: ``randomSplit`` (stable for a fixed input
    partitioning)."""
    return df.randomSplit(list(weights), seed)


def row_key(df: DataFrame, id_col: str | None) -> Column:
    """What splits and folds hang on: the id, or the whole row's content."""
    return F.col(id_col) if id_col is not None else F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"})


def hash_split(df: DataFrame, id_col: str | None = None, train_fraction: float = SPLIT[0],
               seed: int = SPLIT_SEED) -> tuple[DataFrame, DataFrame]:
    """T7, repeatable anywhere: a row is in training when md5(id:seed:split)
    falls under ``train_fraction``. Without an id the row's content counts."""
    in_train = F.coalesce(hash_fraction(row_key(df, id_col), train_fraction, seed, "split"), F.lit(False))
    return df.where(in_train), df.where(~in_train)


def fold_of(key: Column | str, folds: int = NUM_FOLDS, seed: int = SPLIT_SEED) -> Column:
    """M9: the fold of a row, 0 to ``folds`` - 1, from md5(id:seed:fold); a null id is in fold 0."""
    h = F.conv(F.substring(hash_key(key, seed, "fold"), 1, 8), 16, 10).cast("long")
    return F.coalesce(F.floor(h * folds / F.lit(2 ** 32)), F.lit(0)).cast("int")


# --- M1: dictionaries ------------------------------------------------------------

def numbered(df: DataFrame, *order: Column) -> DataFrame:
    """``df`` with ``_n``, its place (from 0) in the given total order. Rows are dealt by range and
    written once with their place in their partition; partitions follow each other, so a
    running count over one row a partition gives the rest."""
    dealt = df.repartitionByRange(*order).sortWithinPartitions(*order)
    at = F.monotonically_increasing_id()                 # partition number * 2**33 + place in it
    placed, _ = write_shared(dealt.withColumn("_at", at), "numbered")
    part = F.shiftright("_at", 33)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_before"))
    return (placed.join(F.broadcast(offsets), part == F.col("_part"))            # one row a partition
            .withColumn("_n", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1)))
            .drop("_at", "_part", "_before"))


def dictionary(df: DataFrame, col: str) -> DataFrame:
    """(value, index long): the non-null values by falling count, then value."""
    counts = df.where(F.col(col).isNotNull()).groupBy(F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("_c"))
    return numbered(counts, F.desc("_c"), F.asc("value")).select("value", F.col("_n").alias("index"))


def string_index(df: DataFrame, col: str) -> DataFrame:
    """M1 applied: ``(col, col_index double)`` for every value present (count desc, then value asc)."""
    return dictionary(df, col).select(F.col("value").alias(col), F.col("index").cast("double").alias(col + "_index"))


# --- M2, M3: features ------------------------------------------------------------

@dataclass
class Features:
    """Fitted features: dictionaries, the one-hot encoder and the columns assembled. Unseen and
    null categories get an extra slot."""
    categorical: list[str]
    numeric: list[str]
    label: str
    dictionaries: dict[str, DataFrame]
    sizes: dict[str, int]
    encoder: OneHotEncoderModel | None = None

    def indexed(self, df: DataFrame) -> DataFrame:
        """``df`` with ``<c>_index`` of each category and, where the label is there, ``label``. Spark
        broadcasts a dictionary while its size allows."""
        for c in self.categorical:
            table = self.dictionaries[c].select(F.col("value").alias(f"_v_{c}"), F.col("index").cast("double").alias(f"{c}_index"))
            df = df.join(table, F.col(c) == F.col(f"_v_{c}"), "left").drop(f"_v_{c}")
            df = df.withColumn(f"{c}_index", F.coalesce(f"{c}_index", F.lit(float(self.sizes[c]))))
        table = self.dictionaries[self.label].select(F.col("value").alias("_v"), F.col("index").cast("double").alias("label"))
        return df.join(table, F.col(self.label) == F.col("_v"), "left").drop("_v")

    def transform(self, df: DataFrame) -> DataFrame:
        out = self.indexed(df)
        if self.encoder is not None:
            out = self.encoder.transform(out)
        return (VectorAssembler(inputCols=[f"{c}_ohe" for c in self.categorical] + list(self.numeric), outputCol="features",
                                handleInvalid="keep").transform(out)
                .drop(*(f"{c}_{x}" for c in self.categorical for x in ("index", "ohe"))))


def fit_features(train: DataFrame, categorical: list[str], numeric: list[str], label: str) -> Features:
    """M1-M3 on the training rows."""
    tables, sizes = {}, {}
    for c in dict.fromkeys([*categorical, label]):
        tables[c], seen = write_shared(dictionary(train, c), "dictionary", n=F.count(F.lit(1)))
        sizes[c] = seen["n"]
    out = Features(list(categorical), list(numeric), label, tables, sizes)
    if categorical:
        # one row a category shows the encoder every index, the extra one included
        most = max(sizes[c] for c in categorical) + 1
        widths = train.sparkSession.range(most).select(
            *(F.least(F.col("id"), F.lit(sizes[c])).cast("double").alias(f"{c}_index") for c in categorical))
        out.encoder = OneHotEncoder(inputCols=[f"{c}_index" for c in categorical], outputCols=[f"{c}_ohe" for c in categorical],
                                    handleInvalid="keep").fit(widths)
    return out


# --- M6, M7: metrics -------------------------------------------------------------

def area_under_roc(scored: DataFrame, score: str = "score", label: str = "label") -> float:
    """M6, exact, ties counted half: distinct scores with their positives and negatives are dealt by
    range, each partition counts its own pairs, and one row a partition gives the pairs between
    partitions. Nulls are left out; without either class the area is 0."""
    def run(batches):
        first, pos, neg, twice = None, 0, 0, 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            s, p, n = (c.to_numpy() for c in batch.columns)
            first = float(s[0]) if first is None else first
            below = np.cumsum(n) - n
            # in halves: positives times (negatives below, and half of those beside)
            twice += sum(a * (2 * (neg + b) + c) for a, b, c in zip(p.tolist(), below.tolist(), n.tolist(), strict=True))
            pos, neg = pos + int(p.sum()), neg + int(n.sum())
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([first]), pa.array([pos]), pa.array([neg]), pa.array([str(twice)])],
                                             ["first", "pos", "neg", "twice"])

    ship_package(scored.sparkSession)
    each = (scored.where(F.col(score).isNotNull() & F.col(label).isNotNull())
            .groupBy((F.col(score).cast("double") + F.lit(0.0)).alias("s"))
            .agg(F.count_if(F.col(label) > 0).alias("p"), F.count_if(F.col(label) <= 0).alias("n")))
    parts = (each.repartitionByRange("s").sortWithinPartitions("s")
             .mapInArrow(run, "first double, pos long, neg long, twice string").collect())
    pos = neg = twice = 0
    for r in sorted(parts, key=lambda r: (r.first != r.first, r.first)):
        twice += int(r.twice) + 2 * r.pos * neg
        pos, neg = pos + r.pos, neg + r.neg
    return twice / (2 * pos * neg) if pos and neg else 0.0


@dataclass
class Evaluation:
    predictions: DataFrame
    auc: float
    accuracy: float


def evaluate(predictions: DataFrame, score: str = "score") -> Evaluation:
    """M6, M7: area under ROC (every score its own threshold) and accuracy of a scored DataFrame,
    which is written once and read for both and by the caller."""
    written, seen = write_shared(predictions, "predictions", right=F.count_if(F.col("label") == F.col("prediction")),
                                 n=F.count("label"))
    return Evaluation(written, area_under_roc(written, score), seen["right"] / seen["n"] if seen["n"] else 0.0)


# --- M4, M5: the classifier ------------------------------------------------------

@dataclass
class Classifier:
    """Features and a fitted regression; ``transform`` adds label, score (of class 1) and prediction."""
    features: Features
    regression: LogisticRegressionModel

    def score(self, ready: DataFrame) -> DataFrame:
        out = self.regression.transform(ready)
        return out.withColumn("score", vector_to_array("probability")[1]).drop("rawPrediction", "probability")

    def transform(self, df: DataFrame) -> DataFrame:
        return self.score(self.features.transform(df)).drop("features")


def _regression(**params) -> LogisticRegression:
    return LogisticRegression(featuresCol="features", labelCol="label", **params)


def _plain(model: LogisticRegressionModel, spark) -> LogisticRegressionModel:
    """The model through the shared folder: tasks get its coefficients, not what training left on it."""
    path = shared_path(spark, "regression")
    model.write().save(path)
    return LogisticRegressionModel.load(path)


def fit(train: DataFrame, categorical: list[str], numeric: list[str], label: str, reg_param: float = REG_PARAM) -> Classifier:
    """M1-M5: index categories by falling frequency, one-hot encode, assemble, logistic regression."""
    features = fit_features(train, categorical, numeric, label)
    ready, _ = write_shared(features.transform(train).select("features", "label"), "features")
    return Classifier(features, _plain(_regression(regParam=reg_param).fit(ready), train.sparkSession))


def fit_and_score(train: DataFrame, test: DataFrame, categorical: list[str], numeric: list[str],
                  label: str, reg_param: float = REG_PARAM) -> tuple[Classifier, Evaluation]:
    model = fit(train, categorical, numeric, label, reg_param)
    return model, evaluate(model.transform(test))


@dataclass
class Tuned(Classifier):
    """The best of a grid, refitted on all training rows; ``grid`` lists every point's mean AUC."""
    grid: list[tuple[float, float, float]] = field(default_factory=list)     # regParam, elasticNetParam, AUC


def tune(train: DataFrame, categorical: list[str], numeric: list[str], label: str,
         seed: int = SPLIT_SEED, num_folds: int = NUM_FOLDS,
         parallelism: int = PARALLELISM, id_col: str | None = None) -> Tuned:
    """M8, M9: 3 x 3 grid over regParam and elasticNetParam, k-fold cross-validation by exact AUC,
    ``parallelism`` fits at a time. Folds follow the id (or the row's content), and all fits share
    one written table of features."""
    spark = train.sparkSession
    features = fit_features(train, categorical, numeric, label)
    keyed = train.withColumn("_fold", fold_of(row_key(train, id_col), num_folds, seed))
    ready, _ = write_shared(features.transform(keyed).select("features", "label", "_fold"), "features")
    points = [(r, e) for r in GRID_REG_PARAM for e in GRID_ELASTIC_NET]

    def auc(job) -> float:
        fold, (reg, net) = job
        model = _plain(_regression(regParam=reg, elasticNetParam=net).fit(ready.where(F.col("_fold") != fold)), spark)
        return area_under_roc(Classifier(features, model).score(ready.where(F.col("_fold") == fold)))

    jobs = [(fold, p) for fold in range(num_folds) for p in points]
    with ThreadPoolExecutor(parallelism) as pool:
        got = dict(zip(jobs, pool.map(auc, jobs), strict=True))
    grid = [(*p, sum(got[fold, p] for fold in range(num_folds)) / num_folds) for p in points]
    reg, net, _ = max(grid, key=lambda g: g[2])              # the first of equals
    best = _plain(_regression(regParam=reg, elasticNetParam=net).fit(ready), spark)
    return Tuned(features, best, grid)


def prediction_breakdown(predictions: DataFrame, key: str) -> DataFrame:
    """``(key, prediction, count)`` ordered by key."""
    return (predictions.groupBy(key, "prediction").agg(F.count(F.lit(1)).alias("count"))
            .select(key, "prediction", "count").orderBy(key))


@dataclass
class Study:
    """Everything the reference's census program prints, as values."""
    train_rows: int
    test_rows: int
    profile: DataFrame          # G8 of ``profile_col`` on the training split
    counts: DataFrame           # G1 + T4 of ``count_col`` on the training split
    model: Classifier
    evaluation: Evaluation      # fixed regParam
    tuned: Tuned
    tuned_evaluation: Evaluation
    breakdowns: dict[str, DataFrame]   # M10 per key


def run_study(df: DataFrame, categorical: list[str], numeric: list[str], label: str,
              profile_col: str, count_col: str, breakdown_keys: list[str],
              seed: int = SPLIT_SEED, id_col: str | None = None) -> Study:
    """The reference's classifier program end to end: split 80/20 (by md5 of ``id_col``, or of the
    row's content), profile one column of the training split, count one category, fit and score the
    fixed pipeline, tune by 3-fold CV and score the best model, and break predictions down by keys.
    The training split is cached while this runs."""
    from lodestone.operators.profile import count_by, profile
    train, test = hash_split(df, id_col, SPLIT[0], seed)
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        n_train, n_test = train.count(), test.count()
        model, ev = fit_and_score(train, test, categorical, numeric, label)
        tuned = tune(train, categorical, numeric, label, seed=seed, id_col=id_col)
        tuned_ev = evaluate(tuned.transform(test))
        counts, _ = write_shared(count_by(train, count_col, order=False), "counts")
        return Study(n_train, n_test, profile(train, profile_col), counts.orderBy(F.desc("count"), count_col),
                     model, ev, tuned, tuned_ev,
                     {k: prediction_breakdown(tuned_ev.predictions, k) for k in breakdown_keys})
    finally:
        train.unpersist()
