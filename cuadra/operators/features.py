"""Feature preparation: category codes, encodings, imputation, scaling, assembly."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import FeatureHasher, Imputer, OneHotEncoder, SQLTransformer, StandardScaler, StringIndexer, VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cuadra.operators.blocks import attach_stats
from cuadra.operators.codes import CodeIndexer


def index_labels(cols: Sequence[str], unseen: str = "error", suffix: str = "_index") -> StringIndexer:
    """Category to number by falling frequency, ties in alphabetical order.

    ``unseen``: ``error`` stops at a value that was not in the training rows, ``skip`` drops its
    row, ``keep`` gives it a number of its own.
    """
    return StringIndexer(inputCols=list(cols), outputCols=[c + suffix for c in cols], handleInvalid=unseen)


def index_by_counts(cols: Sequence[str], unseen: str = "error", suffix: str = "_index") -> CodeIndexer:
    """The same codes from a table, for columns with any number of values; no label reaches the driver."""
    return CodeIndexer(cols, unseen, suffix)


def one_hot(cols: Sequence[str], drop_last: bool = True, suffix: str = "_index", out: str = "_vec") -> OneHotEncoder:
    """Codes to 0/1 vectors; with ``drop_last`` the last category is all zero."""
    return OneHotEncoder(
        inputCols=[c + suffix for c in cols], outputCols=[c + out for c in cols], dropLast=drop_last
    )


def one_hot_indicator(cols: Sequence[str], indexer: Callable[..., Estimator] = index_labels) -> list[Estimator]:
    """One slot per category and one for values not seen in training."""
    return [indexer(cols, unseen="keep"), one_hot(cols, drop_last=False)]


def assemble(cols: Sequence[str], out: str = "features", invalid: str = "error") -> VectorAssembler:
    """Numbers and vectors to one vector; a null is an error unless ``invalid`` says otherwise."""
    return VectorAssembler(inputCols=list(cols), outputCol=out, handleInvalid=invalid)


def impute_mean(cols: Sequence[str], suffix: str = "") -> Imputer:
    """Missing numbers become the training mean."""
    return Imputer(strategy="mean", inputCols=list(cols), outputCols=[c + suffix for c in cols])


def as_doubles(cols: Sequence[str], keep: str = "*") -> SQLTransformer:
    """Every listed column to a double; text that is no number becomes null."""
    casts = ", ".join(f"try_cast(`{c}` AS double) AS `{c}_num`" for c in cols)
    return SQLTransformer(statement=f"SELECT {keep}, {casts} FROM __THIS__")


def standardize_columns(df: DataFrame, cols: Sequence[str], ddof: int = 0, train: DataFrame | None = None) -> DataFrame:
    """(x - mean) / sd by the figures of ``train``; ``ddof`` 0 is the population sd, 1 the sample's.

    A constant column becomes 0.
    """
    sd = F.stddev_pop if ddof == 0 else F.stddev_samp
    stats = (train if train is not None else df).agg(
        *[e for c in cols for e in (F.avg(c).alias(f"_m_{c}"), sd(c).alias(f"_s_{c}"))]
    )
    scaled = {
        c: F.when(F.col(f"_s_{c}") == 0, F.col(c) - F.col(f"_m_{c}")).otherwise(
            (F.col(c) - F.col(f"_m_{c}")) / F.col(f"_s_{c}")
        )
        for c in cols
    }
    return attach_stats(df, stats, []).withColumns(scaled).select(*df.columns)


def standardize_vector(col: str = "features", out: str = "scaled") -> StandardScaler:
    """The vector form; it divides by the sample sd."""
    return StandardScaler(inputCol=col, outputCol=out, withMean=True, withStd=True)


def column_features(
    numeric: Sequence[str], categorical: Sequence[str], out: str = "features", scale: bool = False, unseen: str = "skip",
    indexer: Callable[..., Estimator] = index_labels,
) -> list[Transformer | Estimator]:
    """Stages that turn mixed columns into one vector; other columns pass through.

    Numbers are coerced, imputed by the mean and, with ``scale``, standardised. Categories get one
    slot each but the last, or with ``unseen='keep'`` one slot each and one for unseen values. ``indexer`` is
    ``index_by_counts`` for columns whose values should not be listed on the driver.
    """
    stages: list[Transformer | Estimator] = []
    parts: list[str] = []
    if categorical:
        if unseen == "keep":
            stages += one_hot_indicator(categorical, indexer)
        else:
            stages += [indexer(categorical, unseen=unseen), one_hot(categorical)]
        parts += [f"{c}_vec" for c in categorical]
    if numeric:
        numbers = [f"{c}_num" for c in numeric]
        stages += [as_doubles(numeric), impute_mean(numbers)]
        if scale:
            stages += [assemble(numbers, "numbers"), standardize_vector("numbers", "numbers_scaled")]
            parts.append("numbers_scaled")
        else:
            parts += numbers
    return [*stages, assemble(parts, out)]


# Slots of a hashed vector. Texts that share a slot are told apart by the other columns only.
HASH_SLOTS = 256


def hashed_features(numeric: Sequence[str], texts: Sequence[str], out: str = "features", slots: int = HASH_SLOTS) -> list[Transformer | Estimator]:
    """Like ``column_features``, but every text goes to one of ``slots`` by its hash.

    No list of categories is kept, so columns with any number of distinct values are treated alike.
    A null text has no slot.
    """
    stages: list[Transformer | Estimator] = []
    parts: list[str] = []
    if texts:
        stages.append(FeatureHasher(inputCols=list(texts), outputCol="_hashed", numFeatures=slots))
        parts.append("_hashed")
    if numeric:
        numbers = [f"{c}_num" for c in numeric]
        stages += [as_doubles(numeric), impute_mean(numbers)]
        parts += numbers
    return [*stages, assemble(parts, out)]


def fit_stages(stages: Sequence[Transformer | Estimator], train: DataFrame) -> PipelineModel:
    """Fit stages in order on the training rows; the result transforms any rows."""
    return Pipeline(stages=list(stages)).fit(train)


def slot_names(df: DataFrame, col: str = "features") -> list[str]:
    """The name of each slot of an assembled vector, from its metadata."""
    attrs = df.schema[col].metadata.get("ml_attr", {})
    named = {a["idx"]: a.get("name", str(a["idx"])) for group in attrs.get("attrs", {}).values() for a in group}
    return [named.get(i, str(i)) for i in range(attrs.get("num_attrs", len(named)))]
