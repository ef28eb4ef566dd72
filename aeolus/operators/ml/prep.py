"""Dataset contracts, categorical levels, splits, scaling, class weights."""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.ml.feature import (ElementwiseProduct, OneHotEncoder, StringIndexer,
                                StringIndexerModel, VectorAssembler)
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.storagelevel import StorageLevel

from ...constants import PROBE_FEATURES, ROAD_FEATURES, TEST_SHARE

NULL_LEVEL = "None"


# ---- M1 ------------------------------------------------------------------------

@dataclass(frozen=True)
class DatasetSpec:
    name: str
    numeric: tuple[str, ...]
    categorical: tuple[str, ...]
    regression_target: str
    classification_target: str
    intensity: str
    extra_required: tuple[str, ...] = field(default=("lat", "lon", "event_hour"))

    @property
    def required(self) -> list[str]:
        cols = [*self.numeric, *self.categorical, self.regression_target,
                self.classification_target, *self.extra_required]
        return list(dict.fromkeys(cols))


PROBE_SPEC = DatasetSpec(
    name="kpt",
    numeric=PROBE_FEATURES,
    categorical=("direction_bucket",),
    regression_target="avg_speed_kmh",
    classification_target="is_congested",
    intensity="events_count",
)

ROAD_SPEC = DatasetSpec(
    name="tomtom",
    numeric=ROAD_FEATURES,
    categorical=("road_id",),
    regression_target="current_speed_kmh",
    classification_target="is_congested",
    intensity="current_travel_time_s",
)

SPECS = {PROBE_SPEC.name: PROBE_SPEC, ROAD_SPEC.name: ROAD_SPEC}


def check_dataset(df: DataFrame, spec: DatasetSpec) -> DataFrame:
    """Raise on missing columns; drop rows null (or NaN) in a numeric
    feature or the regression target."""
    missing = [c for c in spec.required if c not in df.columns]
    if missing:
        raise ValueError(f"dataset {spec.name} is missing columns: {missing}")
    return df.dropna(subset=[*spec.numeric, spec.regression_target])


# ---- M2 ------------------------------------------------------------------------

def level_col(c: str) -> Column:
    """Categorical as text; null is a level of its own."""
    return F.coalesce(F.col(c).cast("string"), F.lit(NULL_LEVEL))


def category_levels(df: DataFrame, c: str) -> list[str]:
    """All levels, sorted ascending (a fitted ``StringIndexer``; only the
    distinct labels reach the driver)."""
    model = StringIndexer(inputCol="_lvl", outputCol="_idx", stringOrderType="alphabetAsc",
                          handleInvalid="keep").fit(df.select(level_col(c).alias("_lvl")))
    return list(model.labels)


def level_counts(df: DataFrame, c: str) -> DataFrame:
    """(level, level_index, rows): index in ascending label order."""
    lv = df.select(level_col(c).alias(c))
    model = StringIndexer(inputCol=c, outputCol="level_index", stringOrderType="alphabetAsc").fit(lv)
    counts = lv.groupBy(c).agg(F.count(F.lit(1)).alias("rows"))
    return model.transform(counts).withColumn("level_index", F.col("level_index").cast("int"))


def count_levels(df: DataFrame, c: str) -> int:
    """Number of levels; only the number reaches the driver."""
    return df.agg(F.count_distinct(level_col(c))).first()[0]


def level_scales(train: DataFrame, c: str, levels: list[str]) -> list[float]:
    """1 / population std of each level's indicator on the train rows.

    The std of an indicator follows from its share p: sqrt(p (1 - p)). A level
    that is everywhere or nowhere in them is constant and keeps its scale."""
    rows = train.groupBy(level_col(c).alias("level")).agg(F.count(F.lit(1)).alias("n")).collect()
    n = {r["level"]: r["n"] for r in rows}
    total = sum(n.values()) or 1
    share = [n.get(v, 0) / total for v in levels]
    return [1 / math.sqrt(p * (1 - p)) if 0 < p < 1 else 1.0 for p in share]


# ---- M3, M4 ----------------------------------------------------------------------

def split_flag(key: Column | str, test_share: float = TEST_SHARE, seed: int | None = None) -> Column:
    """True for the test share: first 4 hex digits of sha1(key) below
    ``test_share * 65536``. Deterministic, independent of partitioning, and
    portable to SQL (``randomSplit`` is neither). Stratification holds in
    expectation per class without a shuffle."""
    k = (F.col(key) if isinstance(key, str) else key).cast("string")
    if seed is not None:
        k = F.concat(F.lit(f"{seed}:"), k)
    cut = format(int(round(test_share * 65536)), "04x")
    return F.substring(F.sha1(k), 1, 4) < F.lit(cut)


def hash_split(df: DataFrame, key: str, test_share: float = TEST_SHARE,
               seed: int | None = None) -> DataFrame:
    return df.withColumn("is_test", split_flag(key, test_share, seed))


#: Hex digits of the hash that orders rows, and those that one refinement looks at.
_ORDER_DIGITS, _STEP_DIGITS = 15, 3


def exact_split(df: DataFrame, key: str, label: str, test_share: float = TEST_SHARE,
                seed: int | None = None) -> DataFrame:
    """M4: a split whose test rows are ``round(share * rows)`` of every class.

    In each class the rows with the smallest hashes of the key are the test
    rows. The last one's hash is found without a window over the class: counts
    by the hash's first digits tell the digits it begins with, then counts
    among those rows tell the next ones. Each step is a grouped count of at most
    4096 buckets a class; only per-class rows are kept. Keys are unique (rows
    of one key stay together); a null label is a class."""
    k = F.col(key).cast("string")
    if seed is not None:
        k = F.concat(F.lit(f"{seed}:"), k)
    rows = df.withColumn("_h", F.substring(F.sha1(F.coalesce(k, F.lit(""))), 1, _ORDER_DIGITS))
    slim = rows.select(F.col(label).alias("_class"), "_h")
    # Per class: digits known so far, and test rows still to find among rows that begin so.
    state = slim.groupBy("_class").agg(
        F.floor(F.count(F.lit(1)) * F.lit(test_share) + F.lit(0.5)).cast("long").alias("_need")
    ).withColumn("_known", F.lit(""))
    same = F.col("_class").eqNullSafe(F.col("_c"))
    for begin in range(0, _ORDER_DIGITS, _STEP_DIGITS):
        classes = state.select(F.col("_class").alias("_c"), "_need", "_known")
        # One row a class, and as many classes as the label has values.
        among = slim.join(F.broadcast(classes), same & F.col("_h").startswith(F.col("_known")))
        counts = among.groupBy("_class", "_need", "_known", F.substring("_h", 1, begin + _STEP_DIGITS).alias("_to")).agg(
            F.count(F.lit(1)).alias("_n"))
        upto = Window.partitionBy("_class").orderBy("_to")
        counts = counts.withColumn("_before", F.sum("_n").over(upto) - F.col("_n"))
        # The bucket that holds the last test row; with none to find, no row is below the first.
        state = (counts.where("_before < _need OR (_need = 0 AND _before = 0)")
                 .groupBy("_class").agg(F.max(F.struct("_to", "_before", "_need")).alias("b"))
                 .select("_class", F.col("b._to").alias("_known"), (F.col("b._need") - F.col("b._before")).alias("_need")))
        state = _kept_small(state)
    ends = state.select(F.col("_class").alias("_c"), "_known", "_need")
    return (rows.join(F.broadcast(ends), F.col(label).eqNullSafe(F.col("_c")), "left")
                .withColumn("is_test", (F.col("_need") > 0) & (F.col("_h") <= F.col("_known")))
                .drop("_h", "_c", "_known", "_need"))


def _kept_small(state: DataFrame) -> DataFrame:
    """Computed now, so that later steps don't repeat it: a row a class."""
    return state.sparkSession.createDataFrame(state.collect(), state.schema)


# ---- M5 ------------------------------------------------------------------------

def scaler_stats(train: DataFrame, cols: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population std per column, in one aggregate pass; 0 without rows."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    row = train.agg(*aggs).first()
    return {c: (float(row[f"m{i}"] or 0.0), float(row[f"s{i}"] or 0.0)) for i, c in enumerate(cols)}


def stats_frame(train: DataFrame, cols: list[str]) -> DataFrame:
    """Long (feature, mean, std) table without leaving Spark."""
    aggs = []
    for i, c in enumerate(cols):
        aggs += [F.avg(c).alias(f"m{i}"), F.stddev_pop(c).alias(f"s{i}")]
    wide = train.agg(*aggs)
    stack = ", ".join(f"'{c}', m{i}, s{i}" for i, c in enumerate(cols))
    return wide.selectExpr(f"stack({len(cols)}, {stack}) as (feature, mean, std)")


def standardise(df: DataFrame, stats: dict[str, tuple[float, float]]) -> DataFrame:
    """(x - mean) / std; a constant column (std 0) is divided by 1."""
    return df.withColumns({
        c: (F.col(c) - F.lit(m)) / F.lit(s if s > 0 else 1.0) for c, (m, s) in stats.items()})


# ---- feature matrix ----------------------------------------------------------

@dataclass
class Prepared:
    data: DataFrame            # features standardised, ``features`` vector, ``is_test``
    feature_names: list[str]
    stats: dict[str, tuple[float, float]]
    cached: DataFrame | None = None

    def release(self) -> None:
        if self.cached is not None:
            self.cached.unpersist()
            self.cached = None

    def __enter__(self) -> "Prepared":
        return self

    def __exit__(self, *exc) -> None:
        self.release()


def prepare(df: DataFrame, spec: DatasetSpec, key: str, test_share: float = TEST_SHARE,
            seed: int | None = None, persist: bool = True) -> Prepared:
    """M1-M5: contract check, hash split, train-fitted scaling, sparse one-hot.

    Numeric features are standardised. Indicators are divided by their std but
    not centred, so a row holds one value for each categorical however many
    levels there are. The models leave the intercept unpenalised, and centring
    only moves the intercept: the fits are those of standardised indicators.

    Model fitting passes over the data many times, so the vectors are
    persisted (memory, spilling to disk); a lost block is recomputed from
    lineage. Call ``release()`` (or use ``with``) when done."""
    checked = check_dataset(df, spec).withColumns(
        {c: F.col(c).cast("double") for c in spec.numeric})
    base = hash_split(checked, key, test_share, seed)
    cached = None
    if persist:
        base = base.persist(StorageLevel.MEMORY_AND_DISK)
    train = base.filter(~F.col("is_test"))
    stats = scaler_stats(train, list(spec.numeric))
    out = standardise(base, stats).withColumns({f"_lvl_{c}": level_col(c) for c in spec.categorical})
    names, columns = list(spec.numeric), list(spec.numeric)
    for c in spec.categorical:
        levels = category_levels(base, c)
        if not levels:
            continue
        out = StringIndexerModel.from_labels(levels, inputCol=f"_lvl_{c}",
                                             outputCol=f"_idx_{c}").transform(out)
        # The number of categories comes from the index's metadata.
        out = OneHotEncoder(inputCol=f"_idx_{c}", outputCol=f"_hot_{c}",
                            dropLast=False).fit(out).transform(out)
        out = ElementwiseProduct(scalingVec=Vectors.dense(level_scales(train, c, levels)),
                                 inputCol=f"_hot_{c}", outputCol=f"_scaled_{c}").transform(out)
        names += [f"{c}_{v}" for v in levels]
        columns.append(f"_scaled_{c}")
    vec = VectorAssembler(inputCols=columns, outputCol="features").transform(out)
    vec = vec.drop(*[f"{p}_{c}" for p in ("_lvl", "_idx", "_hot", "_scaled") for c in spec.categorical])
    if persist:
        cached = vec = vec.persist(StorageLevel.MEMORY_AND_DISK)
        vec.count()
        base.unpersist()
    return Prepared(vec, names, stats, cached)


# ---- M11 -----------------------------------------------------------------------

def class_weights(train: DataFrame, label: str) -> DataFrame:
    """Balanced weights n / (n_classes * n_c): (label, rows, weight)."""
    counts = train.groupBy(label).agg(F.count(F.lit(1)).alias("rows"))
    total = F.sum("rows").over(_whole())
    classes = F.count(F.lit(1)).over(_whole())
    return counts.withColumn("weight", total / (classes * F.col("rows")))


def _whole():
    from pyspark.sql import Window
    # ``counts`` has one row per class (two), so a global window is tiny.
    return Window.partitionBy(F.lit(0))


def with_class_weights(df: DataFrame, label: str, train_flag: str = "is_test") -> DataFrame:
    """Attach ``weight`` fitted on the train rows; the per-class table has one
    row per class, a proven bound, so it is broadcast."""
    w = class_weights(df.filter(~F.col(train_flag)), label).select(label, "weight")
    return df.join(F.broadcast(w), on=label, how="left")
