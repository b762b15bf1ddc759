"""Classifiers on the model-ready table.

Per model kind the inputs are prepared as the original scripts did:

* ``logistic_regression``, ``naive_bayes``: numeric columns as they are,
  categorical columns indexed and one-hot encoded;
* ``decision_tree``, ``random_forest``: every input read as a number (the
  vocabulary codes), only the label indexed;
* ``multilayer_perceptron``: categorical columns indexed, not one-hot;
  layers ``[#features, 50, #labels]``.

The training part is persisted while the (iterative) fit runs; persisted
blocks that are lost are recomputed from a deterministic plan.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import cached_property, reduce

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (DecisionTreeClassifier, LogisticRegression,
                                       MultilayerPerceptronClassifier, NaiveBayes,
                                       RandomForestClassifier)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..constants import FOREST_TREES, HIDDEN_UNITS, MODEL_SHORT_NAMES, TRAIN_FRACTION
from ..functions.scalar import to_double
from ..names import as_list, col, quote
from ..session import cut_lineage, drop_path, scratch_path
from ..sources.io import write_table
from .evaluate import summarise, summary_histogram, summary_metrics
from .features import (FEATURES, INDEXED_LABEL, LABEL, IndexModel, assemble, encoded_name, index_categories,
                       indexed_name, one_hot, split_by_key)

KINDS = ("logistic_regression", "decision_tree", "random_forest", "naive_bayes", "multilayer_perceptron")
SHORT = MODEL_SHORT_NAMES


@dataclass
class TrainedModel:
    kind: str
    indexer: IndexModel
    model: PipelineModel
    feature_columns: list[str]
    label_values: list[str]


def _classifier(kind: str, n_features: int, n_classes: int, seed: int):
    if kind == "logistic_regression":
        return LogisticRegression(labelCol=INDEXED_LABEL, featuresCol=FEATURES)
    if kind == "decision_tree":
        return DecisionTreeClassifier(labelCol=INDEXED_LABEL, featuresCol=FEATURES, seed=seed)
    if kind == "random_forest":
        return RandomForestClassifier(labelCol=INDEXED_LABEL, featuresCol=FEATURES,
                                      numTrees=FOREST_TREES, seed=seed)
    if kind == "naive_bayes":
        return NaiveBayes(labelCol=INDEXED_LABEL, featuresCol=FEATURES)
    if kind == "multilayer_perceptron":
        return MultilayerPerceptronClassifier(labelCol=INDEXED_LABEL, featuresCol=FEATURES,
                                              layers=[n_features, HIDDEN_UNITS, n_classes], seed=seed)
    raise ValueError(f"unknown model kind {kind!r}; choose from {KINDS}")


def feature_roles(columns: Sequence[str], kind: str, numeric: Sequence[str],
                  exclude: Sequence[str] = ()) -> tuple[list[str], list[str]]:
    """(numeric, categorical) inputs for a model kind; ``label`` and
    ``exclude`` (keys) are never inputs."""
    skip = set(as_list(exclude)) | {LABEL}
    inputs = [c for c in columns if c not in skip]
    if kind in ("decision_tree", "random_forest"):
        return inputs, []
    nums = [c for c in inputs if c in set(as_list(numeric))]
    return nums, [c for c in inputs if c not in nums]


ONE_HOT = ("logistic_regression", "naive_bayes")


def _usable(kind: str, categorical: Sequence[str], index: IndexModel) -> list[str]:
    """A categorical column with one value in the training part would break the
    one-hot encoder; where there is one, it is left out (Q11) and not indexed
    either, so a test row with another value there is still scored."""
    return [c for c in categorical if kind not in ONE_HOT or index.columns[c].size > 1]


def _numbers(df: DataFrame, kind: str, numeric: Sequence[str]) -> DataFrame:
    """Numeric inputs as double for the MLP, as the original script cast them."""
    if kind != "multilayer_perceptron" or not numeric:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[to_double(col(c), types[c]).alias(c) if c in numeric else col(c) for c in df.columns])


def _fit(indexed: DataFrame, kind: str, numeric: Sequence[str], used: Sequence[str], n_classes: int,
         seed: int) -> tuple[PipelineModel, list[str]]:
    """(One-hot), assembler and classifier on indexed rows."""
    stages: list = []
    if kind in ONE_HOT:
        if used:
            stages.append(one_hot([indexed_name(c) for c in used]))
        feats = [*numeric, *[encoded_name(c) for c in used]]
    else:
        feats = [*numeric, *[indexed_name(c) for c in used]]
    if not feats:
        raise ValueError("no usable input columns")
    stages += [assemble(feats), _classifier(kind, len(feats), n_classes, seed)]
    needed = [*numeric, *[indexed_name(c) for c in used], INDEXED_LABEL]
    indexed = indexed.select(*[col(c) for c in dict.fromkeys(needed)]).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return Pipeline(stages=stages).fit(indexed), feats
    finally:
        indexed.unpersist()


def train_model(train: DataFrame, kind: str, numeric: Sequence[str], categorical: Sequence[str],
                seed: int = 42, num_classes: int | None = None) -> TrainedModel:
    """Fit indexers, (one-hot), assembler and classifier on ``train``."""
    numeric, categorical = as_list(numeric), as_list(categorical)
    train = _numbers(train, kind, numeric).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        index = index_categories(categorical + [LABEL]).fit(train)
        used = _usable(kind, categorical, index)
        own, values = index.subset(used + [LABEL]), index.labels(LABEL)
        model, feats = _fit(own.transform(train), kind, numeric, used, num_classes or len(values), seed)
    finally:
        train.unpersist()
    return TrainedModel(kind, own, model, feats, values)


def score(model: TrainedModel, test: DataFrame) -> DataFrame:
    """Predictions (``indexedLabel``, ``probability``, ``prediction`` ...)."""
    return model.model.transform(model.indexer.transform(test))


def model_frame(table: DataFrame, label: str, labels: Sequence[str], drop: Sequence[str] = (),
                key: str | None = None) -> DataFrame:
    """Keep one label (renamed ``label``), drop the others and the
    not-relevant columns, drop rows that miss a value (P10). The entity key is
    no input, so a NULL key is no missing value."""
    others = [c for c in as_list(labels) if c != label] + [c for c in as_list(drop) if c in table.columns]
    frame = table.drop(*others).withColumnRenamed(label, LABEL)
    return frame.na.drop(how="any", subset=[quote(c) for c in frame.columns if c != key])


@dataclass
class Evaluation:
    label: str
    kind: str
    model: TrainedModel
    metrics: DataFrame
    histogram: DataFrame
    predict: Callable[[], DataFrame]

    @cached_property
    def predictions(self) -> DataFrame:
        """The scored held-out rows, one by one."""
        return self.predict()


CASES = "__cases"  # held-out rows that a case stands for


@dataclass
class _LabelFrame:
    """A label's model frame, written once, and what serves every model kind: one
    index, fitted on the training part, the coded training rows, and the coded
    cases (the held-out rows without their key, equal ones once with their number:
    a model gives equal inputs one score)."""

    frame: DataFrame
    test: DataFrame
    train: DataFrame
    cases: DataFrame
    index: IndexModel
    label_values: list[str]
    scratch: list[str]

    @cached_property
    def coded_test(self) -> DataFrame:
        return self.index.codes(self.test)

    def close(self) -> None:
        """Remove training rows and cases, once every model is fitted and summarised."""
        for path in self.scratch:
            drop_path(self.frame.sparkSession, path)


def _written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """``df`` written as a table of the shared folder and read again: computed once
    (a checkpoint computes twice), and later steps read only the columns they use."""
    path = scratch_path(df.sparkSession, name)
    write_table(df, path)
    return df.sparkSession.read.schema(df.schema).parquet(path), path


def _label_frame(frame: DataFrame, categorical: Sequence[str], key: str, train_fraction: float) -> _LabelFrame:
    frame, _ = _written(frame, "frame")
    train, test = split_by_key(frame, key, train_fraction)
    index = index_categories([*categorical, LABEL]).fit(train)
    inputs = [col(c) for c in frame.columns if c != key]
    cases = test.groupBy(*inputs).agg(F.count(F.lit(1)).alias(CASES))
    (train, trained), (cases, counted) = (_written(index.codes(train.select(*inputs)), "train"),
                                          _written(index.codes(cases), "cases"))
    return _LabelFrame(frame, test, train, cases, index, index.labels(LABEL), [trained, counted])


def _evaluate(data: _LabelFrame, label: str, kind: str, key: str, numeric: Sequence[str], num_classes: int | None,
              seed: int) -> Evaluation:
    """Train on written, coded rows and score the cases; one aggregation of their
    predictions (a row per attempt number at most twice) feeds accuracy and histogram."""
    nums, cats = feature_roles(data.frame.columns, kind, numeric, exclude=[key])
    used = _usable(kind, cats, data.index)
    own = data.index.subset([*used, LABEL])

    def ready(coded: DataFrame) -> DataFrame:
        return _numbers(own.known(coded), kind, nums)

    model, feats = _fit(ready(data.train), kind, nums, used, num_classes or len(data.label_values), seed)
    trained = TrainedModel(kind, own, model, feats, data.label_values)
    summary = cut_lineage(summarise(data.cases, model.transform(ready(data.cases)), count_col=CASES))
    metrics = summary_metrics(summary).select(F.lit(label).alias("label_name"), F.lit(kind).alias("model"),
                                              "accuracy", "n_scored", "n_skipped")
    return Evaluation(label, kind, trained, metrics, summary_histogram(summary),
                      lambda: model.transform(ready(data.coded_test)))


def evaluate_model(table: DataFrame, label: str, labels: Sequence[str], kind: str, key: str,
                   numeric: Sequence[str] = (), drop: Sequence[str] = (), train_fraction: float = TRAIN_FRACTION,
                   seed: int = 42) -> Evaluation:
    """E3 for one label and one model kind: split by key, train, score,
    accuracy and attempts histogram."""
    return evaluate_labels(table, [label], [kind], key, numeric, drop, train_fraction, seed, all_labels=labels)[1][0]


def evaluate_labels(table: DataFrame, labels: Sequence[str], kinds: Sequence[str], key: str,
                    numeric: Sequence[str] = (), drop: Sequence[str] = (), train_fraction: float = TRAIN_FRACTION,
                    seed: int = 42, all_labels: Sequence[str] | None = None) -> tuple[DataFrame, list[Evaluation]]:
    """Every label x every model kind; metrics as one DataFrame. The
    model frame of a label is written, indexed and split once and serves all kinds; the label
    count (the MLP's output width, over the whole set, Q19) is taken from it."""
    runs = []
    for label in as_list(labels):
        frame = model_frame(table, label, all_labels or labels, drop, key)
        roles = [feature_roles(frame.columns, kind, numeric, exclude=[key])[1] for kind in as_list(kinds)]
        data = _label_frame(frame, list(dict.fromkeys(c for cats in roles for c in cats)), key, train_fraction)
        num_classes = None
        for kind in as_list(kinds):
            if kind == "multilayer_perceptron" and num_classes is None:
                num_classes = data.frame.select(col(LABEL)).distinct().count()
            runs.append(_evaluate(data, label, kind, key, numeric,
                                  num_classes if kind == "multilayer_perceptron" else None, seed))
        data.close()
    return reduce(DataFrame.unionByName, [r.metrics for r in runs]), runs
