"""Row checks against a declared schema."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_NESTED = (T.ArrayType, T.StructType, T.MapType)
_LEAST, _MOST = -(1 << 63), (1 << 63) - 1


def _number(column: str, have: T.DataType) -> Column:
    """A text or number as a decimal, null where it is none that a bigint could hold."""
    number = F.col(column).try_cast("decimal(38,9)")
    return F.when(number.between(F.lit(_LEAST), F.lit(_MOST)), number)


def _has_fraction(column: str) -> Column:
    """Whether a text that is a number has a fraction, however small.

    Without an exponent the digits say so; with one, the number as a double does.
    """
    text = F.col(column)
    scaled = text.rlike("[eE]")
    number = text.try_cast("double")
    return F.when(scaled, number != F.floor(number)).otherwise(text.rlike(r"\.\d*[1-9]"))


def _time_of_day(column: str, have: T.DataType) -> Column:
    """Whether a date would lose a time of day."""
    value = F.col(column)
    if isinstance(have, T.DateType):
        return F.lit(False)
    instant = value.try_cast("timestamp_ntz") if isinstance(have, T.StringType) else value
    return instant != F.date_trunc("day", instant)


def _value(column: str, have: T.DataType, want: T.DataType) -> Column:
    """The column in the wanted type; rows that passed the check lose nothing."""
    if have == want:
        return F.col(column)
    if isinstance(want, T.LongType) and isinstance(have, T.StringType):
        return _number(column, have).cast(want)
    return F.col(column).cast(want)


def _problem(column: str, have: T.DataType, want: T.StructField) -> Column:
    """The broken rule of one column as text, or null."""
    value = F.col(column)
    checks = [(value.isNull(), "null")] if not want.nullable else []
    if isinstance(want.dataType, T.LongType):
        if isinstance(have, (T.DoubleType, T.FloatType)):
            checks.append((value.isNotNull() & value.try_cast("bigint").isNull(), "type"))
            checks.append((value != F.floor(value), "fraction"))
        elif isinstance(have, T.DecimalType):
            checks.append((value.isNotNull() & value.try_cast("bigint").isNull(), "type"))
            checks.append((value % 1 != 0, "fraction"))
        elif isinstance(have, T.StringType):
            number = _number(want.name, have)
            checks.append((value.isNotNull() & number.isNull(), "type"))
            checks.append((_has_fraction(want.name), "fraction"))
        elif not isinstance(have, (T.IntegralType, T.BooleanType)):
            checks.append((value.isNotNull(), "type"))
    elif isinstance(want.dataType, _NESTED):
        # nested values have to be what is declared; no part of one is cast
        if have.simpleString() != want.dataType.simpleString():
            checks.append((value.isNotNull(), "type"))
    elif isinstance(want.dataType, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        if isinstance(have, T.StringType):
            checks.append((value.isNotNull() & value.try_cast("timestamp").isNull(), "type"))
        elif not isinstance(have, (T.TimestampType, T.TimestampNTZType, T.DateType)):
            checks.append((value.isNotNull(), "type"))
        if isinstance(want.dataType, T.DateType) and isinstance(have, (T.StringType, T.TimestampType, T.TimestampNTZType)):
            checks.append((_time_of_day(want.name, have), "time"))
    elif type(have) is not type(want.dataType):
        checks.append((value.isNotNull(), "type"))
    rule = F.lit(None).cast("string")
    for broken, name in reversed(checks):
        rule = F.when(broken, name).otherwise(rule)
    return rule


def violations(df: DataFrame, model: T.StructType, keys: Sequence[str]) -> DataFrame:
    """One row per broken rule: the row's key, the column, the rule.

    Rules are ``null``, ``type``, ``fraction`` and ``time`` (a date that has a time of
    day), and ``missing`` for a column the table lacks, reported once without a key.
    Columns the model does not name are ignored.
    """
    kinds = {field.name: field.dataType for field in df.schema.fields}
    present = [want for want in model.fields if want.name in kinds]
    checks = [
        F.struct(
            F.lit(want.name).alias("column"),
            _problem(want.name, kinds[want.name], want).alias("rule"),
        )
        for want in present
    ]
    report = (
        df.select(*keys, F.explode(F.array(*checks)).alias("_check"))
        .select(*keys, "_check.column", "_check.rule")
        .filter(F.col("rule").isNotNull())
    )
    absent = [want.name for want in model.fields if want.name not in kinds]
    if not absent:
        return report
    no_key = (None,) * len(keys)
    rows = [(*no_key, name, "missing") for name in absent]
    fields = [T.StructField(f.name, f.dataType) for f in report.schema.fields]
    return report.unionByName(df.sparkSession.createDataFrame(rows, T.StructType(fields)))


def require(df: DataFrame, model: T.StructType, keep: Sequence[str] = ()) -> DataFrame:
    """``df`` in the model's columns and types; the first bad row fails the job.

    The check rides along with the job that reads or writes the rows instead
    of passing over them once more. ``keep`` lists columns beside the model's.
    """
    kinds = {field.name: field.dataType for field in df.schema.fields}
    absent = [want.name for want in model.fields if want.name not in kinds]
    if absent:
        raise ValueError(f"columns missing: {absent}")
    columns = [F.col(name) for name in keep]
    for want in model.fields:
        rule = _problem(want.name, kinds[want.name], want)
        failure = F.raise_error(F.concat(F.lit(f"column {want.name} breaks rule "), rule))
        kind = kinds[want.name]
        if isinstance(want.dataType, _NESTED) and kind.simpleString() != want.dataType.simpleString():
            value = F.lit(None).cast(want.dataType)  # only a null gets past the check
        else:
            value = _value(want.name, kind, want.dataType)
        columns.append(F.when(rule.isNotNull(), failure).otherwise(value).alias(want.name))
    return df.select(*columns)


class Quarantine(NamedTuple):
    """What a checked landing left: the folder, rows in all, and rejected rows by column and rule."""

    path: str
    rows: int
    rejected: int
    by_rule: dict[tuple[str, str], int]


_BAD = "_rejected"


def land_checked(
    df: DataFrame, model: T.StructType, path: str, most_rejected: float = 1.0, mode: str = "errorifexists"
) -> Quarantine:
    """Write good rows in the model's types and bad rows as they came, in one pass.

    The rows' rules are counted as they are written. A share of bad rows above
    ``most_rejected`` is an error; what was written stays for a look at it, beside its
    ``_SUCCESS``, and nobody reads it as a table. Bad rows keep their values as text.
    """
    kinds = {field.name: field.dataType for field in df.schema.fields}
    absent = [want.name for want in model.fields if want.name not in kinds]
    if absent:
        raise ValueError(f"columns missing: {absent}")
    rules = [_problem(want.name, kinds[want.name], want).alias(want.name) for want in model.fields]
    broken = [
        F.when(rule.isNotNull(), F.struct(F.lit(want.name).alias("column"), rule.alias("rule")))
        for rule, want in zip(rules, model.fields)
    ]
    judged = df.withColumn("_rules", F.array_compact(F.array(*broken)))
    bad = F.size("_rules") > 0
    seen = Observation()
    names = ("null", "type", "fraction", "time")
    counts = [
        F.count(F.when(rule == name, 1)).alias(f"{want.name}/{name}")
        for rule, want in zip(rules, model.fields)
        for name in names
    ]
    judged = judged.observe(
        seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(bad, 1)).alias("rejected"), *counts
    )
    values = [
        F.when(~bad, _value(want.name, kinds[want.name], want.dataType)).alias(want.name)
        if kinds[want.name].simpleString() == want.dataType.simpleString()
        or not isinstance(want.dataType, _NESTED)
        else F.lit(None).cast(want.dataType).alias(want.name)
        for want in model.fields
    ]
    raw = F.when(bad, F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    (
        judged.select(*values, raw.alias("_raw"), F.when(bad, F.col("_rules")).alias("_rules"), bad.alias(_BAD))
        .write.mode(mode).partitionBy(_BAD).parquet(path)
    )
    got = seen.get
    by_rule = {
        tuple(k.rsplit("/", 1)): n for k, n in got.items() if k not in ("rows", "rejected") and n
    }
    if got["rejected"] > most_rejected * got["rows"]:
        raise ValueError(f"{got['rejected']} of {got['rows']} rows rejected: {by_rule}")
    return Quarantine(path, got["rows"], got["rejected"], by_rule)


def accepted_rows(spark: SparkSession, path: str, model: T.StructType) -> DataFrame:
    """The good rows that ``land_checked`` wrote."""
    return _part(spark, path, model, False).select(*[f.name for f in model.fields])


def rejected_rows(spark: SparkSession, path: str, model: T.StructType) -> DataFrame:
    """The bad rows: ``raw``, their values as JSON, and ``rules``, what each column breaks."""
    bad = _part(spark, path, model, True)
    return bad.select(F.col("_raw").alias("raw"), F.col("_rules").alias("rules"))


def _part(spark: SparkSession, path: str, model: T.StructType, bad: bool) -> DataFrame:
    rule = T.StructType().add("column", T.StringType()).add("rule", T.StringType())
    nullable = [T.StructField(f.name, f.dataType) for f in model.fields]
    schema = T.StructType(
        [*nullable, T.StructField("_raw", T.StringType()), T.StructField("_rules", T.ArrayType(rule)),
         T.StructField(_BAD, T.BooleanType())]
    )
    return spark.read.schema(schema).parquet(path).filter(F.col(_BAD) == bad)
