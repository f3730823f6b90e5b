"""Projections, casts, filters and column roles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerlift.sources.retail import FEATURES, TARGET


def select_features(df: DataFrame, features: Sequence[str] = FEATURES, target: str = TARGET):
    """The feature columns and the target: the ten columns models are fed."""
    return df.select(*features, target)


def as_label(df: DataFrame, target: str = TARGET) -> DataFrame:
    return df.withColumnRenamed(target, "label")


def labelled(df: DataFrame, target: str = "label") -> DataFrame:
    """Rows whose outcome is known; new interactions carry a null target."""
    return df.where(F.col(target).isNotNull())


def cast_int(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Cast to int, truncating; what is no number, or too large, gives null."""

    def number(c: str) -> Column:
        is_text = isinstance(df.schema[c].dataType, T.StringType)
        return F.col(c).try_cast("double") if is_text else F.col(c)

    return df.withColumns({c: number(c).try_cast("int") for c in columns})


def column_roles(
    df: DataFrame, target: str, include_float: bool = False
) -> tuple[list[str], list[str]]:
    """Categorical and numeric column names, the target left out.

    Only integer columns count as numeric unless ``include_float`` is set.
    """
    numeric = (T.IntegralType, T.FractionalType) if include_float else (T.IntegralType,)
    fields = [f for f in df.schema.fields if f.name.lower() != target.lower()]
    categorical = [f.name for f in fields if isinstance(f.dataType, T.StringType)]
    return categorical, [f.name for f in fields if isinstance(f.dataType, numeric)]


def role_rows(df: DataFrame, target: str, include_float: bool = False) -> DataFrame:
    """``column_roles`` as rows, with non-null counts measured over the table."""
    categorical, numeric = column_roles(df, target, include_float)
    role = {c: "categorical" for c in categorical} | {c: "numeric" for c in numeric}
    role[target] = "target"
    counts = df.agg(*[F.count(c).alias(c) for c in df.columns])
    rows = [
        F.struct(
            F.lit(i).alias("position"),
            F.lit(f.name).alias("column_name"),
            F.lit(f.dataType.simpleString()).alias("data_type"),
            F.lit(role.get(f.name, "other")).alias("role"),
            F.col(f.name).alias("non_null_rows"),
        )
        for i, f in enumerate(df.schema.fields)
    ]
    return counts.select(F.inline(F.array(*rows)))


def by_class(df: DataFrame, value: int, label: str = "label") -> DataFrame:
    return df.where(F.col(label) == value)


def drop_missing(df: DataFrame, column: str) -> DataFrame:
    return df.dropna(subset=[f"`{column}`" if "." in column else column])


def parse_requests(df: DataFrame, fields: Sequence[str], body: str = "body") -> DataFrame:
    """JSON scoring requests to typed feature columns, all double, and ``error``.

    Field names are matched without regard to case, since clients send them in
    upper case and models are trained on one spelling. A body that is no JSON
    object, or lacks a number for a field, keeps its row with null features and
    a reason in ``error``.
    """
    keep = [c for c in df.columns if c != body]
    parsed = df.withColumn("__body", F.map_entries(F.from_json(F.col(body), "map<string,string>")))

    def number(field: str) -> Column:
        same = F.filter("__body", lambda e: F.lower(e["key"]) == field.lower())
        return F.get(same, F.lit(0))["value"].try_cast("double")

    parsed = parsed.withColumns({f"__{c}": number(c) for c in fields})
    missing = [F.when(F.col(f"__{c}").isNull(), F.lit(f"no number for {c}")) for c in fields]
    broken = F.when(F.col("__body").isNull(), F.lit("no JSON object"))
    parsed = parsed.withColumn("error", F.coalesce(broken, *missing))
    values = [F.when(F.col("error").isNull(), F.col(f"__{c}")).alias(c) for c in fields]
    return parsed.select(*keep, *values, "error")


def ingest_batch(
    df: DataFrame,
    batch_id: Column,
    batch_tms: Column | None = None,
    target: str = TARGET,
) -> DataFrame:
    """New interactions as they arrive: outcome unknown, one batch id and time."""
    unknown = df.withColumn(target, F.lit(None).cast(df.schema[target].dataType))
    return stamp_batch(unknown, batch_id, batch_tms)


def stamp_batch(df: DataFrame, batch_id: Column, batch_tms: Column | None = None) -> DataFrame:
    if batch_tms is None:
        batch_tms = F.current_timestamp().cast("timestamp_ntz")
    return df.withColumns({"batch_id": batch_id, "batch_tms": batch_tms})
