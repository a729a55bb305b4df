"""Spark ML stages that turn contract columns into a feature vector."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.base import Estimator
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowsight.contract import FLOW, Contract
from flowsight.operators.windows import SESSION_FEATURES
from flowsight.session import kept, spread

WINDOW_MODEL_FEATURES = ("flow_rate", "port_scan_ratio", "http_ratio")
# Distinct values of a text column that a fitted stage may hold, and places of a column that is hashed instead.
MOST_VALUES = 10_000
HASHED_VALUES = 1 << 14
# Training rows up to which they are kept in memory beside what a fit holds, and candidates are fitted side by side.
MANY_ROWS = 2_000_000


def wide_columns(rows: DataFrame, columns: Sequence[str], most: int = MOST_VALUES) -> tuple[str, ...]:
    """The columns with more than about ``most`` distinct values, by one pass of sketches of bounded size."""
    if not columns:
        return ()
    found = rows.agg(*[F.approx_count_distinct(name, 0.02).alias(name) for name in columns]).first()
    return tuple(name for name in columns if found[name] > most)


def require_narrow(rows: DataFrame, columns: Sequence[str], most: int = MOST_VALUES) -> None:
    """Fail with the names of the columns that have too many values to be indexed."""
    wide = wide_columns(rows, columns, most)
    if wide:
        raise ValueError(f"more than {most} distinct values: {', '.join(wide)}")


def text_stages(texts: Sequence[str], hashed: Sequence[str] = (), *, drop_last: bool = False) -> tuple[list, list[str]]:
    """Stages that encode text columns, and the vectors they make.

    The distinct values of an indexed column come to the driver and are held by the fitted stage. A
    column in ``hashed`` has a fixed number of places instead, whatever its values, and is not fitted:
    values share a place by chance.
    """
    few = [name for name in texts if name not in hashed]
    indexed, encoded = [f"{c}_index" for c in few], [f"{c}_onehot" for c in few]
    stages: list = []
    if few:
        stages.append(StringIndexer(inputCols=few, outputCols=indexed, handleInvalid="keep", stringOrderType="frequencyDesc"))
        stages.append(OneHotEncoder(inputCols=indexed, outputCols=list(encoded), handleInvalid="keep", dropLast=drop_last))
    for name in texts:
        if name in hashed:
            encoded.append(f"{name}_hashed")
            stages.append(FeatureHasher(inputCols=[name], outputCol=encoded[-1], numFeatures=HASHED_VALUES, categoricalCols=[name]))
    return stages, encoded


def feature_stages(contract: Contract = FLOW, hashed: Sequence[str] = ()) -> list:
    """Indexed and one-hot text columns beside number columns scaled to unit deviation.

    Values unseen in training get a place of their own. Text columns in ``hashed`` are hashed instead.
    """
    stages, encoded = text_stages(contract.categorical, hashed)
    return [
        *stages,
        VectorAssembler(inputCols=contract.numeric, outputCol="numbers", handleInvalid="error"),
        StandardScaler(inputCol="numbers", outputCol="scaled_numbers", withMean=False, withStd=True),
        VectorAssembler(inputCols=["scaled_numbers", *encoded], outputCol="features", handleInvalid="error"),
    ]


def fit_features(rows: DataFrame, contract: Contract = FLOW, most: int = MOST_VALUES) -> PipelineModel:
    """The fitted feature stages; a sketch of the text columns decides first which of them are hashed."""
    return Pipeline(stages=feature_stages(contract, wide_columns(rows, contract.categorical, most))).fit(rows)


def logistic(
    *,
    label: str = "label",
    max_iter: int = 50,
    tol: float = 1e-6,
    reg: float = 0.0,
    elastic_net: float = 0.0,
    weight: str | None = None,
) -> LogisticRegression:
    """Logistic regression on features that are already scaled."""
    model = LogisticRegression(
        labelCol=label, featuresCol="features", maxIter=max_iter, tol=tol, regParam=reg,
        elasticNetParam=elastic_net, fitIntercept=True, standardization=False, threshold=0.5,
    )
    return model.setWeightCol(weight) if weight else model


def forest(
    trees: int, depth: int, *, label: str = "label", bins: int = 32, least_rows: int = 2, subset: str = "sqrt",
    subsample: float = 0.8, seed: int = 42,
) -> RandomForestClassifier:
    return RandomForestClassifier(
        labelCol=label, featuresCol="features", numTrees=trees, maxDepth=depth, maxBins=bins,
        minInstancesPerNode=least_rows, featureSubsetStrategy=subset, subsamplingRate=subsample, seed=seed,
        # else each level walks every row down every tree again
        cacheNodeIds=True,
    )


def sample_forest(*, label: str = "label", seed: int = 42) -> RandomForestClassifier:
    """The small forest for fits on samples."""
    return forest(12, 6, label=label, least_rows=1, subsample=1.0, seed=seed)


@contextmanager
def dealt(rows: DataFrame, many: int = MANY_ROWS) -> Iterator[DataFrame]:
    """The rows spread for fits and held until the block ends: by the executors, beyond ``many`` rows on their disks only.

    A fit holds the rows once more in a form of its own, which it walks many times, while it reads the given ones
    two or three times. Both together would push each other out of the memory.
    """
    level = StorageLevel.DISK_ONLY if rows.count() > many else StorageLevel.MEMORY_AND_DISK
    with kept(spread(rows), level) as held:
        yield held


def contract_model(contract: Contract = FLOW, classifier: Estimator | None = None, hashed: Sequence[str] = ()) -> Pipeline:
    """Feature stages and a classifier in one; by default a logistic regression of one iteration."""
    return Pipeline(stages=[*feature_stages(contract, hashed), classifier or logistic(label=contract.label, max_iter=1)])


def fit_contract_model(
    rows: DataFrame, contract: Contract = FLOW, classifier: Estimator | None = None, most: int = MOST_VALUES
) -> PipelineModel:
    """``contract_model`` fitted, with the text columns of more than ``most`` values hashed."""
    return contract_model(contract, classifier, wide_columns(rows, contract.categorical, most)).fit(rows)


def fit_on_vectors(
    rows: DataFrame, contract: Contract = FLOW, classifier: Estimator | None = None, most: int = MOST_VALUES
) -> PipelineModel:
    """As ``fit_contract_model``, with the classifier fitted on spread vectors: label and features are dealt and kept once.

    ``rows`` should be a written table. Spread whole, it would be dealt and ordered again by every stage that is fitted.
    """
    prepared = fit_features(rows, contract, most)
    with dealt(prepared.transform(rows).select(contract.label, "features")) as ready:
        fitted = (classifier or logistic(label=contract.label, max_iter=1)).fit(ready)
    return PipelineModel(stages=[*prepared.stages, fitted])


def vector_forest(columns: Sequence[str], *, trees: int, depth: int, seed: int = 42) -> Pipeline:
    """A forest on number columns as they are."""
    assembler = VectorAssembler(inputCols=list(columns), outputCol="features", handleInvalid="error")
    return Pipeline(stages=[assembler, forest(trees, depth, subset="auto", subsample=1.0, seed=seed)])


def session_model(*, trees: int = 40, depth: int = 5) -> Pipeline:
    return vector_forest(SESSION_FEATURES, trees=trees, depth=depth)


def window_model(*, trees: int = 30, depth: int = 5) -> Pipeline:
    return vector_forest(WINDOW_MODEL_FEATURES, trees=trees, depth=depth)


FLOW_TEXTS = ("proto", "service")


def flow_model(*, trees: int = 20, depth: int = 6, hashed: Sequence[str] = ()) -> Pipeline:
    """A forest on single flow events: duration, bytes, protocol and service."""
    stages, encoded = text_stages(FLOW_TEXTS, hashed, drop_last=True)
    return Pipeline(
        stages=[
            *stages,
            VectorAssembler(inputCols=["dur", "sbytes", "dbytes", *encoded], outputCol="features", handleInvalid="error"),
            forest(trees, depth, least_rows=1, subset="auto", subsample=1.0),
        ]
    )
