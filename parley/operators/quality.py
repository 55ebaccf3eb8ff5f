"""Checks of events and embeddings: each is one pass over the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.columns import is_blank
from parley.schemas import CONVERSATION

# Types that count as equal in a schema check.
COMPATIBLE = (
    (T.StringType, T.VarcharType),
    (T.TimestampType, T.TimestampNTZType, T.DateType),
    (T.IntegerType, T.LongType, T.DoubleType),
)

# Texts of findings.
MISSING_COLUMN = "Missing required column: {}"
TYPE_MISMATCH = "Column {} type mismatch: expected {}, got {}"
BAD_VALUES = "Found %d %s values in required field: %s"
NO_EMBEDDINGS = "Missing 'embedding' column"
NULL_EMBEDDINGS = "Found {} null embeddings"
EMPTY_EMBEDDINGS = "Found {} empty embeddings"
WRONG_DIMENSION = "Found {} embeddings with wrong dimension (expected {})"
# Own text: such vectors have no distance.
BAD_ELEMENTS = "Found {} embeddings with null or NaN elements"


def _compatible(expected: T.DataType, actual: T.DataType) -> bool:
    return expected == actual or any(isinstance(expected, g) and isinstance(actual, g) for g in COMPATIBLE)


def _schema_faults(df: DataFrame, expected: T.StructType) -> list[str]:
    actual = {f.name: f.dataType for f in df.schema}
    faults = []
    for f in expected:
        if f.name not in actual:
            faults.append(MISSING_COLUMN.format(f.name))
        elif not _compatible(f.dataType, actual[f.name]):
            faults.append(TYPE_MISMATCH.format(f.name, f.dataType.simpleString(), actual[f.name].simpleString()))
    return faults


def required_field_counts(df: DataFrame, expected: T.StructType = CONVERSATION) -> DataFrame:
    """(field, check, n) with the number of null and of blank values of every required field."""
    required = [f.name for f in expected if not f.nullable and f.name in df.columns]
    checks: list[tuple[str, str, Column]] = []
    for name in required:
        checks.append((name, "null", F.count_if(F.col(name).isNull())))
        if isinstance(df.schema[name].dataType, T.StringType):
            checks.append((name, "empty", F.count_if(is_blank(F.col(name)))))
    if not checks:
        return df.sparkSession.createDataFrame([], "field string, check string, n bigint")
    counts = df.agg(*[c.alias(f"c{i}") for i, (_, _, c) in enumerate(checks)])
    rows = [
        F.struct(F.lit(name).alias("field"), F.lit(check).alias("check"), F.col(f"c{i}").alias("n"))
        for i, (name, check, _) in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def schema_errors(df: DataFrame, expected: T.StructType = CONVERSATION) -> DataFrame:
    """All findings of the schema check as rows of ``error``; none means valid."""
    faults = _schema_faults(df, expected)
    found = required_field_counts(df, expected).filter(F.col("n") > 0).select(
        F.format_string(BAD_VALUES, "n", "check", "field").alias("error")
    )
    if not faults:
        return found
    return df.sparkSession.createDataFrame([(f,) for f in faults], "error string").unionByName(found)


def validate_schema(df: DataFrame, expected: T.StructType = CONVERSATION) -> tuple[bool, list[str]]:
    """(ok, errors). At most two findings per declared field come back to the driver."""
    errors = [r["error"] for r in schema_errors(df, expected).collect()]
    return not errors, errors


def embedding_profile(df: DataFrame, expected_dim: int | None = None) -> DataFrame:
    """One row: total, null, empty and wrong-length embeddings, those with null or NaN elements, and the expected length.

    Without ``expected_dim`` the most frequent length is expected. Rows are first counted by length,
    so the second step sees only as many rows as there are lengths.
    """
    lengths = df.groupBy(F.size("embedding").alias("dim"), F.col("embedding").isNull().alias("missing")).agg(
        F.count("*").alias("n"), F.count_if(F.exists("embedding", lambda x: x.isNull() | F.isnan(x))).alias("bad")
    )
    present = ~F.col("missing")
    usual = F.max(F.when(present, F.struct("n", "dim")))["dim"]
    counted = lengths.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_records"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("null_embeddings"),
        F.coalesce(F.sum(F.when(present & (F.col("dim") == 0), F.col("n"))), F.lit(0)).alias("empty_embeddings"),
        (F.lit(expected_dim) if expected_dim else usual).cast("int").alias("expected_dim"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("bad_values"),
        F.collect_list(F.when(present, F.struct("dim", "n"))).alias("lengths"),
    )
    off = F.filter("lengths", lambda x: x["dim"] != F.col("expected_dim"))
    wrong = F.aggregate(off, F.lit(0).cast("bigint"), lambda acc, x: acc + x["n"])
    return counted.withColumn("wrong_dimension", F.when(F.col("expected_dim").isNull(), 0).otherwise(wrong)).drop(
        "lengths"
    )


def validate_embeddings(df: DataFrame, expected_dim: int | None = None) -> tuple[bool, list[str]]:
    if "embedding" not in df.columns:
        return False, [NO_EMBEDDINGS]
    row = embedding_profile(df, expected_dim).first()
    findings = {
        NULL_EMBEDDINGS: row["null_embeddings"],
        EMPTY_EMBEDDINGS: row["empty_embeddings"],
        WRONG_DIMENSION: row["wrong_dimension"],
        BAD_ELEMENTS: row["bad_values"],
    }
    errors = [text.format(n, row["expected_dim"]) for text, n in findings.items() if n]
    return not errors, errors


def detect_anomalies(df: DataFrame) -> DataFrame:
    """One row of anomaly counts. ``anomaly_rate`` adds up the categories; ``affected_rows`` counts rows once."""
    tests: dict[str, Column] = {}
    if "embedding" in df.columns:
        e = F.col("embedding")
        tests["empty_embeddings"] = e.isNull() | (F.size(e) == 0)
    if "message" in df.columns:
        m = F.col("message")
        tests["empty_messages"] = m.isNull() | is_blank(m)
    if "campaign" in df.columns:
        c = F.col("campaign")
        tests["missing_campaigns"] = c.isNull() | (c == "")
    if "timestamp" in df.columns:
        tests["invalid_timestamps"] = F.col("timestamp").isNull()
    any_test = F.lit(False)
    for t in tests.values():
        any_test = any_test | t
    # The categories a profile always lists.
    names = (
        "empty_embeddings", "missing_relationships", "invalid_timestamps", "empty_messages", "missing_campaigns",
        "orphaned_users",
    )
    counts = df.agg(
        *[(F.count_if(tests[n]) if n in tests else F.max(F.lit(0).cast("bigint"))).alias(n) for n in names],
        F.count_if(any_test).alias("affected_rows"),
        F.count("*").alias("total_records"),
    ).select(*[F.coalesce(n, F.lit(0)).alias(n) for n in names], "affected_rows", "total_records")
    found = sum((F.col(n) for n in names[1:]), F.col(names[0]))
    return counts.withColumn(
        "anomaly_rate", F.when(F.col("total_records") > 0, found / F.col("total_records")).otherwise(F.lit(0.0))
    )


def table_fingerprint(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Row count and an order-free digest of the whole content: the sum of a 60-bit prefix of each row's SHA-256.

    Equal tables agree whatever their row order or partitioning, and repeated rows count.
    """
    names = columns or df.columns
    nested = (T.ArrayType, T.MapType, T.StructType)
    parts = [
        F.coalesce(
            F.to_json(n) if isinstance(df.schema[n].dataType, nested) else F.col(n).cast("string"), F.lit("")
        )
        for n in names
    ]
    # told apart from empty texts by a mask
    nulls = F.concat(*[F.col(n).isNull().cast("int").cast("string") for n in names])
    digest = F.sha2(F.concat_ws("\u0001", *parts, nulls), 256)
    prefix = F.conv(F.substring(digest, 1, 15), 16, 10).cast("decimal(20,0)")
    return df.agg(
        F.count("*").alias("row_count"), F.coalesce(F.sum(prefix), F.lit(0)).cast("string").alias("content_sum")
    )
