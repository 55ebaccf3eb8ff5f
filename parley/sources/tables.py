"""Stored tables: keyed tables, day-partitioned documents, appends, CSV and JSON outputs."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parley.functions.columns import epoch_millis, message_id, stringify_nested
from parley.operators.upsert import last_per_key, upsert, upsert_counts
from parley.schemas import DOCUMENT, TABLES, VECTOR_TABLE, conform
from parley.session import TEXT_CODEC, delete_path, materialize, scratch_scope

# Partitions of a keyed table.
KEY_PARTS = 64
# Bytes of a file of a compacted table.
COMPACT_BYTES = 128 << 20
# Bits that mark repeated ids in a merge, 16 MB, and those of one bitmap of Spark's.
MARK_BITS = 1 << 27
BITMAP_BITS = 1 << 15


def list_dirs(spark: SparkSession, path: str) -> list[str]:
    jvm = spark._jvm
    folder = jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(folder)] if fs.exists(folder) else []


class KeyedTable:
    """A Parquet table partitioned by a hash of its key. An upsert reads and rewrites the partitions that its keys fall into, no others.

    Merged partitions are first written to the shared scratch folder, so a failure there leaves the table as it was.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: list[str], parts: int = KEY_PARTS):
        self.spark, self.path, self.keys, self.parts = spark, path.rstrip("/"), keys, parts
        self.schema = schema
        self.stored = T.StructType([*schema.fields, T.StructField("part", T.IntegerType())])

    def _placed(self, df: DataFrame) -> DataFrame:
        return conform(df, self.schema).withColumn("part", F.pmod(F.xxhash64(*self.keys), F.lit(self.parts)).cast("int"))

    def _rows(self) -> DataFrame:
        if not list_dirs(self.spark, self.path):
            return self.spark.createDataFrame([], self.stored)
        return self.spark.read.schema(self.stored).parquet(self.path)

    def read(self) -> DataFrame:
        return self._rows().select(*self.schema.names)

    def _write(self, rows: DataFrame, mode: str) -> None:
        rows.hint("rebalance", F.col("part")).write.mode("overwrite").option("partitionOverwriteMode", mode).partitionBy("part").parquet(self.path)

    def replace(self, df: DataFrame) -> None:
        """The whole table anew, with one row of each key."""
        self._write(materialize(last_per_key(self._placed(df), self.keys), "replacing"), "static")

    def upsert(self, batch: DataFrame, order: list[Column] | None = None) -> None:
        rows = materialize(self._placed(batch), "keyed_batch")
        # at most ``parts`` numbers
        touched = [r["part"] for r in rows.select("part").distinct().collect()]
        if not touched:
            return
        stored = self._rows().filter(F.col("part").isin(touched)).select(*rows.columns)
        self._write(materialize(upsert(stored, rows, self.keys, order), "merged"), "dynamic")


def documents(df: DataFrame) -> DataFrame:
    """Messages as documents with nested metadata."""
    embedding = F.col("embedding") if "embedding" in df.columns else F.lit(None).cast("array<float>")
    processed = (
        F.col("processing_timestamp") if "processing_timestamp" in df.columns else F.current_timestamp()
    )
    return df.select(
        message_id().alias("message_id"),
        "userid",
        "message",
        "timestamp",
        "campaign",
        processed.alias("processing_timestamp"),
        F.struct(
            embedding.isNotNull().alias("has_embedding"),
            F.coalesce(F.size(embedding), F.lit(0)).alias("embedding_dim"),
        ).alias("metadata"),
    )


def _repeated(ids: DataFrame) -> DataFrame:
    """(bucket, bits): bitmaps over hashes of the ids that occur more than once, MARK_BITS bits in all however many these are."""
    again = ids.groupBy(F.xxhash64("message_id").alias("h")).agg(F.count("*").alias("n")).filter("n > 1")
    place = again.select(F.pmod("h", F.lit(MARK_BITS)).alias("place"))
    return place.groupBy(F.expr(f"place div {BITMAP_BITS}").alias("bucket")).agg(F.bitmap_construct_agg(F.expr(f"place % {BITMAP_BITS}")).alias("bits"))


def _marked(rows: DataFrame, repeated: DataFrame) -> DataFrame:
    """``rows`` with ``_met``: whether the id may be a repeated one. Each that is repeated is marked, and few others."""
    place = F.pmod(F.xxhash64("message_id"), F.lit(MARK_BITS))
    placed = rows.withColumn("_place", place).withColumn("bucket", F.expr(f"_place div {BITMAP_BITS}")).withColumn("_place", F.expr(f"_place % {BITMAP_BITS}"))
    # a bitmap of 4 KB for each bucket
    looked = placed.join(F.broadcast(repeated), "bucket", "left")
    met = F.expr("getbit(CAST(conv(hex(substring(bits, CAST(_place div 8 + 1 AS INT), 1)), 16, 10) AS INT), CAST(_place % 8 AS INT)) = 1")
    return looked.withColumn("_met", F.coalesce(met, F.lit(False))).drop("bucket", "bits", "_place")


def merged_documents(existing: DataFrame, batch: DataFrame) -> DataFrame:
    """Stored documents with the batch's put in by ``message_id``: of an id the batch's last row, by processing time, else the stored one.

    Of rows of the same time the one with the largest values stays. Texts are shuffled only of rows whose id occurs more
    than once; hashes of the ids tell which. All others stay in the tasks that read them. Both tables are read twice, so pass stored ones.
    """
    repeated = _repeated(existing.select("message_id").unionAll(batch.select("message_id")))
    rows = existing.withColumn("_new", F.lit(False)).unionByName(batch.withColumn("_new", F.lit(True)))
    marked = _marked(rows, materialize(repeated, "repeated_ids"))
    values = [F.desc(c) for c in batch.columns if c not in ("message_id", "processing_timestamp")]
    last = Window.partitionBy("message_id").orderBy(F.desc("_new"), F.desc("processing_timestamp"), *values)
    met = marked.filter("_met").withColumn("_nth", F.row_number().over(last)).filter("_nth = 1")
    return marked.filter("NOT _met").select(*batch.columns).unionByName(met.select(*batch.columns))


def store_documents(spark: SparkSession, df: DataFrame, path: str) -> dict[str, int]:
    """Upsert messages into the document table at ``path``; returns {inserted, updated, errors, total}.

    The id contains the time, so a message can only collide with one of the same day. The table is
    partitioned by day and only days found in the batch are read, merged and replaced. Spark stages the merged days
    beside the table and moves them in when all are written: a failure before that leaves the table untouched.
    """
    with scratch_scope(spark):
        batch = materialize(conform(documents(df), DOCUMENT).withColumn("day", F.to_date("timestamp")), "batch")
        schema = T.StructType([*DOCUMENT.fields, T.StructField("day", T.DateType())])
        if list_dirs(spark, path):
            # calendar days: a short list whatever the size of the batch, and it prunes partitions statically
            days = [r["day"] for r in batch.select("day").distinct().collect()]
            touched = F.col("day").isin([d for d in days if d is not None])
            if None in days:
                touched = touched | F.col("day").isNull()
            existing = spark.read.schema(schema).parquet(path).filter(touched).select(*batch.columns)
        else:
            existing = spark.createDataFrame([], schema)
        counts = upsert_counts(existing, batch, ["message_id"]).first()
        (
            merged_documents(existing, batch)
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .option("compression", TEXT_CODEC)
            .partitionBy("day")
            .parquet(path)
        )
    return {"inserted": counts["inserted"], "updated": counts["updated"], "errors": 0, "total": counts["total"]}


def latest_documents(docs: DataFrame, limit: int = 100, user: str | None = None, campaign: str | None = None) -> DataFrame:
    """The latest documents of one user or of one campaign."""
    if user is not None:
        docs = docs.filter(F.col("userid") == user)
    if campaign is not None:
        docs = docs.filter(F.col("campaign") == campaign)
    return docs.orderBy(F.desc_nulls_last("timestamp"), "message_id").limit(limit)


def vector_rows(df: DataFrame) -> DataFrame:
    """The vector table's rows: an automatic id, the stable message id, ids as text and time in ms."""
    missing = {"userid", "campaign", "message", "timestamp", "embedding"} - set(df.columns)
    if missing:
        raise ValueError(f"missing required columns: {sorted(missing)}")
    return conform(
        df.select(
            F.monotonically_increasing_id().alias("id"),
            message_id().alias("message_id"),
            F.col("userid").alias("user_id"),
            F.col("campaign").alias("campaign_id"),
            "message",
            epoch_millis(df, "timestamp").alias("timestamp"),
            "embedding",
        ),
        VECTOR_TABLE,
    )


def store_vectors(df: DataFrame, path: str) -> None:
    vector_rows(df).write.mode("overwrite").option("compression", TEXT_CODEC).parquet(path)


def save_embeddings(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", TEXT_CODEC).parquet(path)


def load_embeddings(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def save_table(
    df: DataFrame, path: str, mode: str = "overwrite", flat: bool = False, lookup: str | None = None
) -> None:
    """Save an aggregate: ``overwrite`` replaces, anything else appends. ``flat`` turns nested columns into JSON text.

    ``lookup`` names a column that is filtered by value later: files then hold disjoint ranges of it in
    order, and Parquet statistics skip all but one.
    """
    out = stringify_nested(df) if flat else df
    if lookup:
        out = out.repartitionByRange(lookup).sortWithinPartitions(lookup)
    out.write.mode("overwrite" if mode == "overwrite" else "append").parquet(path)


def save_daily(df: DataFrame, path: str) -> None:
    """The daily table, replacing only the days in ``df``, so that a rerun does not double them."""
    (
        df.hint("rebalance", F.col("activity_date"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("activity_date")
        .parquet(path)
    )


def create_tables(spark: SparkSession, database: str | None = None) -> list[str]:
    """Create the analytics tables if they are missing."""
    names = [f"{database}.{t}" if database else t for t in TABLES]
    for name, schema in zip(names, TABLES.values()):
        columns = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet")
    return names


def fill_table(df: DataFrame, name: str) -> None:
    """Replace the rows of a created table, by its declared columns."""
    schema = df.sparkSession.table(name).schema
    materialize(conform(df, schema), "filling").write.mode("overwrite").insertInto(name)


def export_csv(df: DataFrame, path: str) -> None:
    stringify_nested(df).write.mode("overwrite").option("header", True).csv(path)


def export_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def jdbc_options(
    host: str,
    port: int | str,
    database: str,
    user: str,
    password: str,
    table: str | None = None,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int | None = None,
    batch_size: int = 1000,
) -> dict[str, str]:
    """Options for ``spark.read/write.format("jdbc")``; with a partition column the read is split into ranges."""
    options = {
        "url": f"jdbc:postgresql://{host}:{port}/{database}",
        "user": user,
        "password": password,
        "driver": "org.postgresql.Driver",
        "batchsize": str(batch_size),
    }
    if table:
        options["dbtable"] = table
    if partition_column:
        if not (bounds and partitions):
            raise ValueError("a partitioned read needs bounds and a number of partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(bounds[0]),
            "upperBound": str(bounds[1]),
            "numPartitions": str(partitions),
        }
    return options


def read_jdbc(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def save_jdbc(df: DataFrame, options: dict[str, str], mode: str = "overwrite") -> None:
    stringify_nested(df).write.format("jdbc").options(**options).mode(mode).save()


def compact(spark: SparkSession, source: str, target: str) -> None:
    """Rewrite a table of small files into files of some COMPACT_BYTES. Files are read one after the other, so no row is shuffled."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(source)
    size = folder.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(folder).getLength()
    rows = spark.read.parquet(source).coalesce(max(1, -(-size // COMPACT_BYTES)))
    rows.write.mode("overwrite").option("compression", TEXT_CODEC).parquet(target)


def expire_days(spark: SparkSession, path: str, before: str, column: str = "day") -> list[str]:
    """Drop the partitions of days before ``before`` (YYYY-MM-DD) from a table partitioned by day.

    The partition of rows without a day has no age, so it stays.
    """
    days = [d.removeprefix(f"{column}=") for d in list_dirs(spark, path) if d.startswith(f"{column}=")]
    days = [d for d in days if d != "__HIVE_DEFAULT_PARTITION__"]
    old = sorted((d for d in days if date.fromisoformat(d) < date.fromisoformat(before)), key=date.fromisoformat)
    for day in old:
        delete_path(spark, f"{path}/{column}={day}")
    return old
