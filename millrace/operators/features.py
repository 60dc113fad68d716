"""Customer features: computed, looked up, upserted, and joined as of a point in time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.changes import diff
from millrace.operators.orders import MONEY
from millrace.sizing import lookup_join

HIGH_VALUE = 500
FEATURE_COLUMNS = ["total_orders", "avg_order_value", "months_active", "high_value_ratio"]
# Slices for the as-of join, from coarse to fine, and how many rows of one key a slice may hold.
SLICE_UNITS = ("month", "day", "hour", "minute", "second")
SLICE_ROWS = 1_000_000
PUBLISH_MODES = ("SNAPSHOT", "TRIGGERED", "CONTINUOUS")


def customer_features(orders: DataFrame, high_value: float = HIGH_VALUE) -> DataFrame:
    """One row per customer. The distinct months are counted after a first aggregation by customer and month, so a
    customer with very many orders is combined before the shuffle like any other."""
    by_month = orders.groupBy(
        F.col("o_custkey").alias("customer_key"), F.date_format("o_orderdate", "yyyy-MM").alias("month")
    ).agg(
        F.count("o_orderkey").alias("orders"),
        F.count("o_totalprice").alias("priced"),
        F.sum("o_totalprice").alias("spent"),
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("o_totalprice") > high_value).alias("high"),
    )
    return by_month.groupBy("customer_key").agg(
        F.sum("orders").alias("total_orders"),
        (F.sum("spent") / F.sum("priced")).cast(MONEY).alias("avg_order_value"),
        F.count("month").alias("months_active"),
        (F.sum("high") / F.sum("rows")).alias("high_value_ratio"),
    )


def require_unique(df: DataFrame, key: str) -> DataFrame:
    """Fail when ``key`` is NULL or repeated. Reads the key column only."""
    bad = df.groupBy(key).count().filter(F.col(key).isNull() | (F.col("count") > 1)).limit(1).count()
    if bad:
        raise ValueError(f"{key} must be unique and not NULL")
    return df


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """All rows of ``new``, and those of ``old`` whose key is not in ``new``."""
    kept = old.join(new.select(key), key, "left_anti")
    return new.unionByName(kept)


def lookup_json(keys: DataFrame, features: DataFrame, key: str = "customer_key") -> DataFrame:
    """The features of each key as one JSON string; NULL for unknown keys."""
    packed = features.select(key, F.to_json(F.struct(*FEATURE_COLUMNS)).alias("features_json"))
    return keys.join(packed, key, "left")


# Keys are unique, so max() only tells Spark that there is at most one row, which makes calls over a table a plain join.
LOOKUP_FUNCTION = """
CREATE OR REPLACE TEMPORARY FUNCTION {name}(customer BIGINT) RETURNS STRING
RETURN SELECT max(to_json(struct({columns}))) FROM {view} WHERE customer_key = customer
"""


def register_lookup(features: DataFrame, name: str, view: str) -> None:
    """A SQL function that returns one customer's features as JSON. Spark turns calls over a table into a join."""
    features.createOrReplaceTempView(view)
    features.sparkSession.sql(LOOKUP_FUNCTION.format(name=name, view=view, columns=", ".join(FEATURE_COLUMNS)))


def publish_set(old: DataFrame, new: DataFrame, key: str, mode: str = "TRIGGERED") -> DataFrame:
    """The rows to send to a serving store, with what changed: all of them for a snapshot, else only the difference."""
    if mode not in PUBLISH_MODES:
        raise ValueError(f"publish mode must be one of {PUBLISH_MODES}, not {mode!r}")
    if mode == "SNAPSHOT":
        return new.withColumn("change_type", F.lit("snapshot"))
    changed = diff(old, new, key)
    return changed.join(new, key, "left").select(*new.columns, "change_type")


def order_day_features(orders: DataFrame) -> DataFrame:
    """One feature row per customer and order time."""
    return orders.groupBy(F.col("o_custkey").alias("customer_key"), F.col("o_orderdate").alias("feature_time")).agg(
        F.count("o_orderkey").alias("day_orders"), F.sum("o_totalprice").cast(MONEY).alias("day_spent")
    )


def fine_enough(times: DataFrame, key: str, time: str, most: int = SLICE_ROWS) -> str:
    """The coarsest time slice in which no key has more than ``most`` rows. Counting combines before the shuffle."""
    for unit in SLICE_UNITS[:-1]:
        per_slice = times.groupBy(key, F.date_trunc(unit, F.col(time))).count()
        if (per_slice.agg(F.max("count")).first()[0] or 0) <= most:
            return unit
    return SLICE_UNITS[-1]


def as_of_join(
    labels: DataFrame,
    features: DataFrame,
    key: str,
    label_time: str,
    feature_time: str,
    slice_unit: str | None = None,
) -> DataFrame:
    """Each label with the latest feature row of its key at or before the label's time.

    ``features`` holds one row per key and time; a row at the label's own time is visible.

    The history of a key is cut into time slices, so that a key with very many rows is many small groups. Inside a slice a
    running window finds the latest feature. Where the slice has none yet, the answer is the last feature of an earlier
    slice; that is looked up among one row per key and slice. Equal label times are answered once. Unless a unit is
    given, the slices are as fine as the busiest key needs.
    """
    if slice_unit is None:
        both = labels.select(key, F.col(label_time).alias("_t")).unionAll(features.select(key, feature_time))
        slice_unit = fine_enough(both, key, "_t")
    values = [c for c in features.columns if c not in (key, feature_time)]
    row = F.struct(F.col(feature_time), *values)
    row_type = features.select(row.alias("r")).schema["r"].dataType.simpleString()
    cut = lambda time: F.date_trunc(slice_unit, time)

    known = features.select(key, F.col(feature_time).alias("_t"), row.alias("_f"))
    asked = labels.select(key, F.col(label_time).alias("_t")).distinct()
    points = (
        known.withColumn("_asked", F.lit(0))
        .unionByName(asked.withColumns({"_f": F.lit(None).cast(row_type), "_asked": F.lit(1)}))
        .withColumn("_slice", cut(F.col("_t")))
    )
    so_far = Window.partitionBy(key, "_slice").orderBy("_t", "_asked").rowsBetween(Window.unboundedPreceding, 0)
    filled = points.withColumn("_f", F.last("_f", ignorenulls=True).over(so_far))
    answered = filled.filter("_asked = 1")

    # One row per key and slice, asked or known: what is the last feature before this slice? The rows lie together
    # already, so neither counting the slices nor filling them moves data again.
    slices = filled.groupBy(key, "_slice").agg(F.max_by("_f", F.struct("_t", "_asked")).alias("_f"))
    before = Window.partitionBy(key).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    carried = slices.select(key, "_slice", F.last("_f", ignorenulls=True).over(before).alias("_carried"))

    answers = answered.join(carried, [key, "_slice"], "left").select(
        key, F.col("_t").alias(label_time), F.coalesce("_f", "_carried").alias("_f")
    )
    joined = labels.join(answers, [key, label_time], "left")
    return joined.select(*labels.columns, F.col(f"_f.{feature_time}").alias(feature_time), *[f"_f.{c}" for c in values])


def features_for(keys: DataFrame, features: DataFrame, key: str) -> DataFrame:
    """The feature rows of many keys at once; unknown keys get NULLs. A long key list is spread, a short one broadcast."""
    wanted = keys.select(key).distinct()
    return wanted.join(lookup_join(features, wanted, [key], "left_semi"), key, "left")
