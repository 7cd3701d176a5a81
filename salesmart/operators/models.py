"""Training, evaluation, comparison and versioned storage of MLlib models."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import IndexToString, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from salesmart.functions.quantiles import find_quantiles
from salesmart.functions.ranking import running_total
from salesmart.operators.features import CHURN_FEATURES, ITEM_FEATURES, ORDER_FEATURES, ml_split
from salesmart.sources.files import folder_numbers
from salesmart.storage import materialize


@dataclass
class Task:
    name: str
    key: str
    features: list[str]
    label: str
    multiclass: bool = False


ORDER_TASK = Task("high_value_order", "order_id", ORDER_FEATURES, "is_high_value")
CHURN_TASK = Task("customer_churn", "customer_id", CHURN_FEATURES, "churned")
ITEM_TASK = Task("item_class", "item_id", ITEM_FEATURES, "business_class", multiclass=True)


def label_high_value(split: DataFrame, share: float = 0.90) -> DataFrame:
    """Label orders by the value quantile of the training side only. ``split`` is read several times: pass a stored table."""
    cut = find_quantiles(split.where("side = 'train'"), [("q", "total_amount", share)])["q"]
    return split.withColumn("threshold", F.lit(cut).cast("double")).withColumn("is_high_value", (F.col("total_amount") >= F.col("threshold")).cast("long"))


def estimator(task: Task, family: str, n_train: int, trees: int = 150, seed: int = 42) -> Pipeline:
    """Pipeline of a model family: random forest, boosted trees, or scaled logistic regression.

    The logistic penalty 1/n equals a unit L2 penalty on the summed loss.
    """
    if family == "logistic":
        raw = VectorAssembler(inputCols=task.features, outputCol="raw")
        scale = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
        stages = [raw, scale, LogisticRegression(labelCol="label", maxIter=100, regParam=1.0 / max(n_train, 1))]
    else:
        learner = {
            "forest": lambda: RandomForestClassifier(labelCol="label", numTrees=trees, seed=seed),
            "boosted": lambda: GBTClassifier(labelCol="label", maxIter=20, seed=seed),
        }[family]()
        stages = [VectorAssembler(inputCols=task.features, outputCol="features"), learner]
    return Pipeline(stages=stages)


def train(task: Task, split: DataFrame, family: str, trees: int = 150) -> PipelineModel:
    """Fit on the training side. Text labels are indexed first and decoded after the classifier."""
    rows = split.where("side = 'train'")
    n_train = rows.count()
    if not task.multiclass:
        return estimator(task, family, n_train, trees).fit(rows.withColumn("label", F.col(task.label).cast("double")))
    indexer = StringIndexer(inputCol=task.label, outputCol="label", handleInvalid="error").fit(rows)
    fitted = estimator(task, family, n_train, trees).fit(indexer.transform(rows))
    decoder = IndexToString(inputCol="prediction", outputCol="predicted_class", labels=indexer.labels)
    return PipelineModel(stages=[*fitted.stages, decoder])


def positive_probability(column: str = "probability") -> Column:
    return vector_to_array(F.col(column))[1]


def score(model: PipelineModel, rows: DataFrame, task: Task) -> DataFrame:
    """Key, actual label, prediction and (binary) positive probability."""
    out = model.transform(rows)
    if task.multiclass:
        return out.select(task.key, F.col(task.label).alias("actual"), F.col("predicted_class").alias("predicted"), F.array_max(vector_to_array("probability")).alias("probability"))
    return out.select(task.key, F.col(task.label).cast("long").alias("actual"), F.col("prediction").cast("long").alias("predicted"),
                      positive_probability().alias("probability"))


def confusion_metrics(scored: DataFrame) -> DataFrame:
    """Accuracy, macro F1 and F1 of class 1 from the (actual, predicted) counts."""
    cells = scored.groupBy(F.col("actual").cast("string").alias("a"), F.col("predicted").cast("string").alias("p")).agg(F.count("*").alias("n"))
    sides = cells.select("n", F.explode(F.array(
        F.struct(F.col("a").alias("c"), F.lit("a").alias("s")), F.struct(F.col("p").alias("c"), F.lit("p").alias("s")),
        F.struct(F.when(F.col("a") == F.col("p"), F.col("a")).alias("c"), F.lit("t").alias("s")))).alias("x")).where("x.c is not null")
    per_class = sides.groupBy("x.c").agg(*[F.coalesce(F.sum(F.when(F.col("x.s") == s, F.col("n"))), F.lit(0)).alias(s) for s in ("a", "p", "t")])
    f1 = F.when(F.col("a") + F.col("p") > 0, 2 * F.col("t") / (F.col("a") + F.col("p"))).otherwise(F.lit(0.0))
    return per_class.withColumn("f1", f1).agg(
        F.sum("a").alias("cases"), (F.sum("t") / F.sum("a")).alias("accuracy"), F.avg("f1").alias("macro_f1"),
        F.max(F.when(F.col("c") == "1", F.col("f1"))).alias("f1"))


def roc_auc(scored: DataFrame) -> DataFrame:
    """Exact area under the ROC curve with ties counted half.

    Scores are reduced to distinct values; the running number of negatives above
    each value comes from bucketed totals, not from one global sort. Null with one class only.
    """
    per_value = materialize(scored.groupBy("probability").agg(
        F.sum("actual").alias("pos"), F.sum(1 - F.col("actual")).alias("neg")), "scores")
    above = running_total(per_value, "probability", None, {"neg_above": "neg"})
    total_pos, total_neg = F.sum("pos").cast("double"), F.sum("neg").cast("double")
    wins = F.sum(F.col("pos").cast("double") * (F.col("neg_above") + F.col("neg") / 2))
    return above.agg((1 - F.try_divide(wins, total_pos * total_neg)).alias("roc_auc"))


def evaluate(scored: DataFrame, task: Task) -> DataFrame:
    """One metrics row for a task."""
    stored = materialize(scored, "scored")
    m = confusion_metrics(stored)
    auc = F.lit(None).cast("double") if task.multiclass else roc_auc(stored).scalar()
    return m.select(F.lit(task.name).alias("task"), "cases", "accuracy", "f1", "macro_f1", auc.alias("roc_auc"))


def _mean_label(both: DataFrame) -> DataFrame:
    """Mean of two positive probabilities; label 1 from one half on."""
    mean = both.withColumn("probability_ensemble", (F.col("probability_a") + F.col("probability_b")) / 2)
    return mean.withColumn("ensemble_label", F.when(F.col("probability_ensemble") >= 0.5, 1).otherwise(0).cast("long"))


def ensemble(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Ensemble of two stored prediction tables."""
    pa = a.select(key, F.col("probability").alias("probability_a"))
    pb = b.select(key, F.col("probability").alias("probability_b"))
    return _mean_label(pa.join(pb, key))


def ensemble_score(a: PipelineModel, b: PipelineModel, rows: DataFrame, task: Task) -> DataFrame:
    """Score with both models in one pass over the rows: no join, no shuffle."""
    inputs = [task.key, *task.features]
    first = a.transform(rows.select(inputs)).select(*inputs, positive_probability().alias("probability_a"))
    both = b.transform(first).select(task.key, "probability_a", positive_probability().alias("probability_b"))
    return _mean_label(both)


def ensemble_classes(a: DataFrame, b: DataFrame, key: str, labels: list[str]) -> DataFrame:
    """Multiclass form: element-wise mean of two aligned class vectors, then the best class."""
    both = a.select(key, F.col("classes").alias("ca")).join(b.select(key, F.col("classes").alias("cb")), key)
    mean = both.withColumn("mean", F.zip_with("ca", "cb", lambda x, y: (x + y) / 2))
    names = F.array(*[F.lit(n) for n in labels])
    return mean.select(key, F.array_max("mean").alias("probability"), F.element_at(names, F.array_position("mean", F.array_max("mean")).cast("int")).alias("ensemble_class"))


def align(cases: DataFrame, a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Cases with the predictions of two models side by side."""
    left = a.select(key, F.col("predicted").alias("pred_a"), F.col("probability").alias("prob_a"))
    right = b.select(key, F.col("predicted").alias("pred_b"), F.col("probability").alias("prob_b"))
    return cases.join(left, key, "left").join(right, key, "left")


# What a task knows about a disagreement: (SQL condition on the aligned row, text).
AMOUNT_FAR_ABOVE_MEAN = ("far_above", "order is far above the mean of its customer")
NEAR_THE_QUIET_LIMIT = ("abs(recency_days - 60) <= 15", "last order lies near the limit between quiet and active")
NEITHER_IS_RIGHT = ("pred_a <> actual AND pred_b <> actual", "item lies between classes: neither model names its class")


def dual_compare(aligned: DataFrame, task_rules: list[tuple[str, str]] = ()) -> DataFrame:
    """Match flag and, for disagreements, an explanation: of all tasks first, then of this one, then by the gap."""
    gap = F.abs(F.col("prob_a") - F.col("prob_b"))
    why = F.when(F.abs(F.col("prob_b") - 0.5) < 0.2, "probability near one half")
    for condition, text in task_rules:
        why = why.when(F.expr(condition), text)
    why = why.when(gap < 0.15, "probabilities are close").otherwise("models weigh the features differently")
    return aligned.withColumn("match", F.col("pred_a").eqNullSafe(F.col("pred_b"))).withColumn("explanation", F.when(F.col("match"), "").otherwise(why))


def dual_summary(compared: DataFrame, task: str) -> DataFrame:
    """Agreement, both accuracies, label distribution and mean probability gap."""
    hit = lambda p: F.count(F.when(p, 1))
    classes = compared.groupBy(F.col("actual").cast("string").alias("k")).agg(F.count("*").alias("n")).agg(
        F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "n")))))).scalar()
    gap = F.abs(F.col("prob_a") - F.col("prob_b"))
    sums = compared.agg(
        F.count("*").alias("cases"), hit(F.col("match")).alias("matching_cases"), hit(F.col("pred_a") == F.col("actual")).alias("_a"),
        hit(F.col("pred_b") == F.col("actual")).alias("_b"), F.avg(gap).alias("_g"))
    n = F.col("cases")
    return sums.select(
        F.lit(task).alias("task"), "cases", "matching_cases", (n - F.col("matching_cases")).alias("disagreeing_cases"),
        (F.col("matching_cases") * 100.0 / n).alias("agreement_percentage"), (F.col("_a") / n).alias("accuracy_a"), (F.col("_b") / n).alias("accuracy_b"),
        F.round("_g", 9).alias("mean_abs_probability_gap"), classes.alias("class_distribution"))


# ---- versioned storage -----------------------------------------------------


def _version_path(root: str, task: str, version: int) -> str:
    return f"{root}/{task}/v{version}"


def latest_version(spark: SparkSession, root: str, task: str) -> int:
    """Highest stored version, 0 when there is none."""
    return max(folder_numbers(spark, f"{root}/{task}", "v"), default=0)


def save_model(spark: SparkSession, root: str, task: Task, family: str, model: PipelineModel, metrics: DataFrame) -> int:
    """Store the next version: the pipeline and one metadata row as JSON."""
    version = latest_version(spark, root, task.name) + 1
    path = _version_path(root, task.name, version)
    model.write().save(f"{path}/model")
    meta = metrics.withColumns({"version": F.lit(version), "family": F.lit(family), "features": F.lit(",".join(task.features)), "key": F.lit(task.key)})
    meta.coalesce(1).write.json(f"{path}/metadata")
    return version


def load_latest(spark: SparkSession, root: str, task: str) -> PipelineModel:
    return PipelineModel.load(f"{_version_path(root, task, latest_version(spark, root, task))}/model")


META_DDL = "task string, cases long, accuracy double, f1 double, macro_f1 double, roc_auc double, version int, family string, features string, key string"


def model_catalog(spark: SparkSession, root: str) -> DataFrame:
    """All stored versions; the highest of a task is active, the others archived."""
    meta = spark.read.schema(META_DDL).json(f"{root}/*/*/metadata")
    newest = meta.groupBy("task").agg(F.max("version").alias("_newest"))
    return meta.join(newest, "task").withColumn("status", F.when(F.col("version") == F.col("_newest"), "active").otherwise("archived")).drop("_newest")


def churn_risk(model: PipelineModel, behaviour: DataFrame) -> DataFrame:
    """Churn probability and risk of every active customer."""
    p = model.transform(behaviour).withColumn("churn_probability", positive_probability())
    risk = F.when(F.col("churn_probability") >= 0.7, "High").when(F.col("churn_probability") >= 0.4, "Medium").otherwise("Low")
    return p.select("customer_id", risk.alias("churn_risk"), "churn_probability", "recency_days", "total_orders", "total_spend", "average_order_value")


def prepared_split(frame: DataFrame, key: str, held_out: DataFrame | None = None, label: str | None = None) -> DataFrame:
    """Stored train/test frame without the held-out cases; the fixed layout keeps seeded training repeatable."""
    return materialize(ml_split(frame, key, held_out=held_out, label=label).repartition(key).sortWithinPartitions(key), "split")


def held_out_cases(frame: DataFrame, key: str, held_out: DataFrame) -> DataFrame:
    """The rows of ``frame`` that no training may see: what two models are compared on."""
    return frame.join(held_out.select(key).distinct(), key, "left_semi")
