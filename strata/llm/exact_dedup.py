"""Exact deduplication as a stateful stream.

Arrivals (digest, stable identifier, content locator) flow through a Structured
Streaming aggregation whose state lives in RocksDB, keyed by digest and never
expired.  The state keeps, per digest, the identifier and the locator of the row
that stays and the number of arrivals.  A digest that arrived more than once is a
*hit*: the full bytes of all its rows are compared (only their texts are shuffled), and rows
whose bytes differ although their digests agree are grouped by their bytes instead.

Only DataFrame functions run on the executors.

Defined results: a null text counts as empty; texts that agree after lower-casing
A-Z are equal; of equal texts the row with the largest ``doc_id`` stays (null is
smallest), of rows that also share the ``doc_id`` the one with the largest
locator; an empty table gives an empty result; columns other than ``doc_id`` and
``text`` are carried by ``keep_rows`` and ignored by ``assign_groups``.  Column names
that begin with ``__xd_`` are reserved.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, freeze, join_spread, remove, scratch

FILE, ROW = "__xd_file", "__xd_row"


def normal_text() -> Column:
    return ascii_lower(F.coalesce(F.col("text"), F.lit("")))


def sha256_hex(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def located(docs: DataFrame) -> DataFrame:
    """``docs`` with a content locator: file and row number.  A table that is
    not read from files is written to the shared scratch space first."""
    if ROW in docs.columns:
        return docs
    try:
        return docs.select("*", F.col("_metadata.file_path").alias(FILE), F.col("_metadata.row_index").alias(ROW))
    except AnalysisException:
        return located(freeze(docs, "exact-dedup-input"))


def run_state(spark: SparkSession, arrivals: str, schema, files_per_trigger: int) -> DataFrame:
    """Stream the arrivals folder through the keyed state; returns one row per
    digest: ``digest, stays (struct of doc_id, file, row), n``."""
    updates, progress = scratch(spark, "exact-dedup-updates"), scratch(spark, "exact-dedup-state")
    own = spark.newSession()  # the state store settings stay out of the caller's session
    for key in ("spark.sql.shuffle.partitions", "spark.sql.session.timeZone"):
        own.conf.set(key, spark.conf.get(key))
    own.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    for key, value in {
        "boundedMemoryUsage": "true",
        "maxMemoryUsageMB": "256",
        # many small stores: no preallocated files, and batches upload their changes only
        "allowFAllocate": "false",
        "changelogCheckpointing.enabled": "true",
    }.items():
        own.conf.set(f"spark.sql.streaming.stateStore.rocksdb.{key}", value)

    state = (
        own.readStream.schema(schema)
        .option("maxFilesPerTrigger", files_per_trigger)
        .parquet(arrivals)
        .groupBy("digest")
        .agg(F.max(F.struct("doc_id", FILE, ROW)).alias("stays"), F.count(F.lit(1)).alias("n"))
    )
    # a batch that is repeated after a failure overwrites its own folder
    query = (
        state.writeStream.outputMode("update")
        .option("checkpointLocation", progress)
        .trigger(availableNow=True)
        .foreachBatch(lambda batch, i: batch.write.mode("overwrite").parquet(f"{updates}/batch={i}"))
        .start()
    )
    query.awaitTermination()
    remove(spark, progress)
    kinds = schema["doc_id"].dataType.simpleString()
    out = spark.read.schema(
        f"digest string, stays struct<doc_id:{kinds},{FILE}:string,{ROW}:bigint>, n bigint, batch int"
    ).parquet(updates)
    # the count of a digest only grows, so its largest update is its last
    last = out.groupBy("digest").agg(F.max(F.struct("n", "stays")).alias("last"))
    return last.select("digest", "last.stays", "last.n")


FILTER_BITS = 1 << 24


def maybe_in(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """The rows whose digest may be among ``keys``: a bit for each hash of a digest, 64 to a word, in a
    broadcast table of at most 2^18 words.  It only drops rows that are certainly not among them."""
    bit = F.pmod(F.xxhash64("digest"), F.lit(FILTER_BITS))
    word, place = F.shiftright(bit, 6).alias("__xd_word"), bit.bitwiseAND(F.lit(63)).cast("int")
    bits = keys.select(word, place.alias("p")).groupBy("__xd_word").agg(F.bit_or(F.expr("shiftleft(1L, p)")).alias("__xd_bits"))
    met = rows.select("*", word, place.alias("__xd_place")).join(F.broadcast(bits), "__xd_word")
    return met.filter(F.getbit("__xd_bits", F.col("__xd_place")) == 1).drop("__xd_word", "__xd_place", "__xd_bits")


def assign_groups(
    docs: DataFrame,
    digest: Callable[[Column], Column] = sha256_hex,
    batches: int = 3,
) -> DataFrame:
    """One row per row of ``docs``: ``doc_id, digest, keep_id, group_size, kept``
    and the locator.  ``digest`` maps the normalised text to the state's key (a
    weak one is still exact, by the byte check); ``batches`` is about how many
    micro-batches the stream takes."""
    spark = docs.sparkSession
    docs = located(docs).select("doc_id", "text", FILE, ROW)
    path = scratch(spark, "exact-dedup-arrivals")
    docs.select("doc_id", digest(normal_text()).alias("digest"), FILE, ROW).write.parquet(path)
    arrivals = spark.read.parquet(path)
    if arrivals.isEmpty():
        nothing = arrivals.withColumns({"keep_id": F.col("doc_id"), "group_size": F.lit(0).cast("long")})
        return nothing.select("doc_id", "digest", "keep_id", "group_size", F.lit(True).alias("kept"), FILE, ROW)
    per_batch = -(-len(arrivals.inputFiles()) // batches)
    state = freeze(run_state(spark, path, arrivals.schema, per_batch), "exact-dedup-groups")

    # hits: the bytes decide.  Only texts that may be hits leave their scan, and equal rows
    # collapse in the map-side half of the aggregate
    shared = state.filter("n > 1").select("digest", "n")
    texts = docs.select(digest(normal_text()).alias("digest"), normal_text().alias("bytes"), "doc_id", FILE, ROW)
    hits = join_spread(maybe_in(texts, shared), shared, "digest", [FILE, ROW]).drop("n")
    by_bytes = hits.groupBy("digest", "bytes").agg(
        F.max(F.struct("doc_id", FILE, ROW)).alias("stays"), F.count(F.lit(1)).alias("n")
    )
    variants = freeze(by_bytes.groupBy("digest").agg(F.count(F.lit(1)).alias("variants")).filter("variants > 1"), "exact-dedup-variants")

    def rows(joined: DataFrame) -> DataFrame:
        return joined.select(
            "doc_id",
            "digest",
            F.col("stays.doc_id").alias("keep_id"),
            F.col("n").alias("group_size"),
            ((F.col(FILE) == F.col(f"stays.{FILE}")) & (F.col(ROW) == F.col(f"stays.{ROW}"))).alias("kept"),
            FILE,
            ROW,
        )

    if variants.isEmpty():
        return rows(join_spread(arrivals, state, "digest", [FILE, ROW]))
    # digests that stand for several texts: the bytes are the key
    split = hits.join(variants, "digest", "left_semi").join(by_bytes, ["digest", "bytes"])
    single = state.join(variants, "digest", "left_anti")
    return rows(join_spread(arrivals, single, "digest", [FILE, ROW])).unionByName(rows(split))


def keep_rows(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs = located(docs)
    dropped = assign_groups(docs, **options).filter(~F.col("kept")).select(FILE, ROW)
    return docs.join(dropped, [FILE, ROW], "left_anti").drop(FILE, ROW)
