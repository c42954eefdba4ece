"""Readers of lead files and landing folders."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..cluster import checkpointed, fresh
from ..functions import text as X
from ..operators.lookup import looked_up


def heads(spark: SparkSession, files: list[str], length: int) -> list[bytes]:
    """The first bytes of each file, decompressed where its name says so. Read through Hadoop's file systems by the driver, some files at a time: so many bytes of each, whatever its size."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf)

    def head(file: str) -> bytes:
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
        stream, codec = path.getFileSystem(conf).open(path), codecs.getCodec(path)
        try:
            return bytes((codec.createInputStream(stream) if codec is not None else stream).readNBytes(length))
        finally:
            stream.close()

    with ThreadPoolExecutor(16) as pool:
        return list(pool.map(head, files))


def json_leads(spark: SparkSession, path: str, schema: T.StructType | str, whole: int = 64 << 20) -> DataFrame:
    """The objects of files that each hold one JSON list of objects, behind white space of any kind. A file whose top level is something else is an error, as is malformed JSON.

    Tasks look at the files, the driver at the largest one's size only: if none has over ``whole`` bytes each is read by one task, else all are read in parts (see ``split_lists``). Errors come up when rows are read.
    """
    kind = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    largest = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0]  # names and sizes, no contents
    if largest is not None and largest > whole:
        return split_lists(spark, path, kind)
    texts = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_path").alias("file"))
    listed = F.when(F.col("value").rlike(f"^{_BLANK}\\["), F.regexp_replace("value", f"^{_BLANK}\\[", "[")).otherwise(F.raise_error(F.concat("file", F.lit(": the top level must be a list"))))
    return texts.select(F.explode(F.from_json(listed, T.ArrayType(kind), {"mode": "FAILFAST"})).alias("x")).select("x.*")


#: What may stand before a list: a byte order mark and white space.
_BLANK = r"\x{FEFF}?[\s\x0B]*"


def split_lists(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """json_leads for large files: each is read by as many tasks as it has splits.

    Text is cut behind each closing brace, which Spark's text reader does split by split. Whether a brace is part of a string, and how deep it lies, follows from all text before it: each fragment says what it does to both
    states, splits add that up, and running sums over splits (a row for each) and inside them give each fragment its state. Fragments up to a brace of the outermost depth are an object. An object must fit one row.
    """
    read = spark.read.option("lineSep", "}").text(path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"))
    rows = checkpointed(read).withColumn("id", F.monotonically_increasing_id())
    split, inside = ["file", "at"], Window.partitionBy("file", "at").orderBy("id")

    def added_up(df: DataFrame, value: str, into: str) -> DataFrame:
        """df with the sum of ``value`` over the file up to this fragment."""
        sums = df.groupBy(*split).agg(F.sum(value).alias("s_")).withColumn("s_", F.sum("s_").over(Window.partitionBy("file").orderBy("at")) - F.col("s_"))
        before = sums.select(F.col("file").alias("file_"), F.col("at").alias("at_"), "s_")
        same = (F.col("file") == F.col("file_")) & (F.col("at") == F.col("at_"))
        return checkpointed(df.withColumn(into, F.sum(value).over(inside)).join(before, same).withColumn(into, F.col(into) + F.col("s_")).drop("file_", "at_", "s_"))

    bare = F.regexp_replace("value", r"(?s)\\.", "")  # without escaped characters
    count = lambda t, c: F.length(t) - F.length(F.replace(t, F.lit(c), F.lit("")))
    strings = lambda t: F.regexp_replace(t, '"[^"]*("|$)', "")  # noqa: E731  without strings, of a text that begins outside one
    rows = rows.withColumns({"flips": count(bare, '"') % 2, "opens": count(strings(bare), "{"), "opens_inside": count(strings(F.regexp_replace(bare, '^[^"]*("|$)', "")), "{")})
    last = rows.groupBy("file").agg(F.max(F.struct("at", "id")).alias("last_")).select(F.col("file").alias("file_"), "last_")
    rows = rows.join(last, F.col("file") == F.col("file_")).withColumn("tail", F.struct("at", "id") == F.col("last_")).drop("file_", "last_")  # behind the last brace
    rows = added_up(rows, "flips", "upto")
    starts_inside, ends_inside = (F.col("upto") - F.col("flips")) % 2 == 1, F.col("upto") % 2 == 1
    closes = F.when(F.col("tail") | ends_inside, 0).otherwise(1)
    rows = rows.withColumn("closes", closes).withColumn("deeper", F.when(starts_inside, F.col("opens_inside")).otherwise(F.col("opens")) - F.col("closes"))
    rows = added_up(rows, "deeper", "depth").withColumn("done", ((F.col("closes") == 1) & (F.col("depth") == 0)).cast("long"))
    rows = added_up(rows, "done", "object").withColumn("object", F.col("object") - F.col("done"))
    parts = rows.groupBy("file", "object").agg(F.sort_array(F.collect_list(F.struct("at", "id", "value"))).alias("parts"), F.max("tail").alias("tail"))
    text = F.array_join(F.transform("parts", lambda p: p["value"]), "}")
    wrong = lambda what: F.raise_error(F.concat("file", F.lit(f": {what}")))
    first = F.col("object") == 0
    begun = F.when(first, text.rlike(rf"^{_BLANK}\[")).otherwise(text.rlike(r"^[\s]*[,\]]"))
    checked = F.when(first & ~begun, wrong("the top level must be a list")).when(~begun, wrong("malformed list"))
    end = F.when(text.rlike(rf"^(?:{_BLANK}\[)?[\s\x0B]*\][\s\x0B]*$"), F.lit(None).cast("string")).otherwise(wrong("the list does not end"))
    one = F.concat(F.regexp_replace(text, rf"^{_BLANK}[\[,][\s]*", ""), F.lit("}"))
    objects = parts.select(F.coalesce(checked, F.when(F.col("tail"), end).otherwise(one)).alias("one")).filter("one is not null")
    return objects.select(F.from_json("one", schema, {"mode": "FAILFAST"}).alias("x")).select("x.*")


def csv_leads(spark: SparkSession, path: str, aliases: dict[str, list[str]], sep: str = ",") -> DataFrame:
    """A CSV with header; each column from the first non-blank of its aliases that exist, empty if none does."""
    raw = spark.read.option("header", True).option("sep", sep).option("multiLine", True).csv(path)
    return raw.select(*[X.first_nonblank(*[F.col(f"`{a}`") for a in names if a in raw.columns]).alias(c) if any(a in raw.columns for a in names) else F.lit("").alias(c) for c, names in aliases.items()])


def sniffed_separator(spark: SparkSession, path: str, head: int = 4096) -> str:
    """A semicolon if the first file's first bytes have more of them than commas; no more than these is read."""
    files = sorted(spark.read.text(path).inputFiles())
    data = heads(spark, files[:1], head)[0] if files else b""
    return ";" if data.count(b";") > data.count(b",") else ","


def csv_sniffed(spark: SparkSession, path: str, aliases: dict[str, list[str]]) -> DataFrame:
    return csv_leads(spark, path, aliases, sniffed_separator(spark, path))


def vendor_feeds(spark: SparkSession, path: str, sources: list[str]) -> DataFrame:
    """The sources' partitions of one landing table (partitioned by source); other partitions are not read."""
    return spark.read.parquet(path).filter(F.col("source").isin(*sources))


def latest_run(table: DataFrame, run: str = "run_id", exclude: tuple[str, ...] = ("backup", "report", "scores")) -> DataFrame:
    """The rows of the newest run, ignoring runs whose id holds an excluded word."""
    runs = table.filter(~X.any_contains(F.lower(run), list(exclude)))
    newest = runs.agg(F.max(run).alias("newest"))
    return runs.join(F.broadcast(newest), F.col(run) == F.col("newest"), "left_semi")


def latest_file(spark: SparkSession, path: str, schema: str, exclude: tuple[str, ...] = ("backup", "report", "scores"), since: float | None = None) -> DataFrame:
    """The rows of the newest file of a folder of Parquet files, by modification time (seconds since 1970: since)."""
    files = spark.read.schema(schema).parquet(path).select("*", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_modification_time").alias("_time"))
    files = files.filter(~X.any_contains(F.lower("_file"), list(exclude)))
    if since is not None:
        files = files.filter(F.col("_time") >= F.timestamp_seconds(F.lit(since)))
    newest = files.agg(F.max(F.struct("_time", "_file"))["_file"].alias("newest"))
    return files.join(F.broadcast(newest), F.col("_file") == F.col("newest"), "left_semi").drop("_file", "_time")


def campaigns(registry: DataFrame, folders: DataFrame) -> DataFrame:
    """(client, campaign_id, created_at) from client documents (client, campaigns); clients without registered campaigns fall back to their folders (client, folder)."""
    listed = registry.select("client", F.explode("campaigns").alias("c")).select("client", "c.campaign_id", "c.created_at")
    rest = folders.join(listed.select(F.col("client").alias("c_")).distinct(), F.col("client") == F.col("c_"), "left_anti").select("client", F.col("folder").alias("campaign_id"), F.lit("").alias("created_at")).distinct()
    return listed.unionByName(rest)


def pages_of(sites: DataFrame, pages: DataFrame, key: str, site: str, order: tuple[str, ...] = ()) -> DataFrame:
    """sites with the stored page (url, html) of each, the last of several (see ``lookup``); ``status`` error where none is stored."""
    page = fresh(sites.columns, "_page")
    joined = looked_up(sites, pages, F.col(site), F.col("url"), {"html": F.col("html")}, page, order)
    return joined.select(key, site, F.col(f"{page}.html").alias("html"), F.when(F.col(page).isNull(), "error").otherwise("success").alias("status"))


def id_map(spark: SparkSession, path: str, known: DataFrame) -> DataFrame:
    """(id, name): pairs learned earlier, kept as JSON lines, which go before those in memory (known)."""
    learned = spark.read.schema("id string, name string").json(path)
    rest = known.select("id", "name").join(learned.select(F.col("id").alias("i_")).distinct(), F.col("id") == F.col("i_"), "left_anti")
    return learned.unionByName(rest)
