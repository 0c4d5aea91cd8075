"""Incremental reprocessing by a ledger of runs, and windowed counts over an event stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from scriptoria.sources.tables import shared_folder, tokens


def due(documents: DataFrame, ledger: DataFrame, task: str, forced: bool = False) -> DataFrame:
    """Documents(doc_id, modified) that a task must process: never run, changed since, or forced."""
    runs = ledger.where(F.col("task") == task).groupBy("doc_id").agg(F.max("last_run").alias("last_run"))
    out = documents.join(runs, "doc_id", "left")
    return out.where(F.lit(forced) | F.col("last_run").isNull() | (F.col("modified") > F.col("last_run")))


def recorded(ledger: DataFrame, done: DataFrame, task: str) -> DataFrame:
    """The ledger with the runs in done(doc_id, last_run): the last of each document and task stays."""
    both = ledger.select("doc_id", "task", "last_run").unionByName(done.select("doc_id", F.lit(task).alias("task"), "last_run"))
    return both.groupBy("doc_id", "task").agg(F.max("last_run").alias("last_run"))


def due_after(ledger: DataFrame, task: str, before: str) -> DataFrame:
    """Documents whose run of before is later than that of task, or that lack the latter."""
    first = ledger.where(F.col("task") == before).select("doc_id", F.col("last_run").alias("_before"))
    own = ledger.where(F.col("task") == task).select("doc_id", F.col("last_run").alias("_own"))
    return first.join(own, "doc_id", "left").where("_own is null or _before > _own").select("doc_id")


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """A file stream of the event table."""
    stream = spark.readStream.schema(spark.read.parquet(path).schema)
    file = spark._jvm.org.apache.hadoop.fs.Path(path)
    if file.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(file).isFile():  # a stream reads folders
        return stream.option("pathGlobFilter", file.getName()).parquet(file.getParent().toString())
    return stream.parquet(path)


def windowed_counts(events: DataFrame, size: str, slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Events and their sum of values by window and type; later than late is dropped."""
    window = F.window("ts", size, slide) if slide else F.window("ts", size)
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if rows.isStreaming:
        rows = rows.withWatermark("ts", late)
    return rows.groupBy(window.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total"))


def sessions(events: DataFrame, gap: str, late: str = "10 minutes") -> DataFrame:
    """Sessions of each user: events with no pause of gap between them."""
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    if rows.isStreaming:
        rows = rows.withWatermark("ts", late)
    return rows.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count("*").alias("n"))


def run_to_end(stream: DataFrame, name: str) -> DataFrame:
    """Process all that a stream has now, each batch replacing the result so far, and read it back.

    Complete mode: the batch with the whole result is written to a folder of its own number, so a
    repeated batch overwrites only itself.
    """
    spark = stream.sparkSession
    folder = shared_folder(spark, name)
    done: list[int] = []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={number}")
        done.append(number)

    query = stream.writeStream.outputMode("complete").foreachBatch(write).option("checkpointLocation", f"{folder}-state").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{folder}/batch={done[-1]}") if done else spark.createDataFrame([], stream.schema)


def replace_documents(index_path: str):
    """A foreachBatch function that replaces the postings of the documents in each batch.

    Each batch is written to a folder of its own number, so that a repeated batch overwrites only
    itself, then a table of its documents, without which nothing of it counts; so a batch that fails between the two changes
    nothing. A batch that a base of compacted() already holds is left alone. current_postings reads what holds now.
    """
    def write(batch: DataFrame, number: int) -> None:
        if number <= _base(batch.sparkSession, index_path):
            return
        rows = tokens(batch).groupBy("doc_id", F.col("word").alias("term"), "line").agg(F.array_sort(F.collect_list("i")).alias("positions"))
        rows.withColumn("part", F.pmod("doc_id", F.lit(64))).write.mode("overwrite").partitionBy("part").parquet(f"{index_path}/postings/batch={number}")
        batch.select("doc_id").distinct().write.mode("overwrite").parquet(f"{index_path}/documents/batch={number}")

    return write


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    """The numbers of the folders name=<number> in path that were written to the end."""
    place, files = _folder(spark, path)
    if not files.exists(place):
        return []
    names = [f.getPath().getName() for f in files.listStatus(place)]
    return sorted(int(n.partition("=")[2]) for n in names if n.startswith(f"{name}=") and files.exists(_folder(spark, f"{path}/{n}/_SUCCESS")[0]))


def _base(spark: SparkSession, index_path: str) -> int:
    return max(_numbers(spark, f"{index_path}/bases", "documents"), default=-1)


def current_postings(spark: SparkSession, index_path: str) -> DataFrame:
    """(doc_id, term, line, positions) of each document's latest batch; a document left empty by it has none.

    Reads the last base and the batches after it.
    """
    base = _base(spark, index_path)
    later = [n for n in _numbers(spark, f"{index_path}/documents", "batch") if n > base]
    places = [(n, f"documents/batch={n}", f"postings/batch={n}") for n in later] + ([(base, f"bases/documents={base}", f"bases/postings={base}")] if base >= 0 else [])
    documents = postings = None
    for number, of, lists in places:
        table = spark.read.schema("doc_id long").parquet(f"{index_path}/{of}").withColumn("batch", F.lit(number))
        rows = spark.read.schema("doc_id long, term string, line int, positions array<int>").parquet(f"{index_path}/{lists}").withColumn("batch", F.lit(number))
        documents, postings = (table, rows) if documents is None else (documents.unionByName(table), postings.unionByName(rows))
    if postings is None:
        return spark.createDataFrame([], "doc_id long, term string, line int, positions array<int>")
    last = documents.groupBy("doc_id").agg(F.max("batch").alias("batch"))
    return postings.join(last, ["doc_id", "batch"], "left_semi").select("doc_id", "term", "line", "positions")


def compacted(spark: SparkSession, index_path: str) -> int:
    """Merge the last base and all batches after it into a new base, then delete what it replaces; returns the base's number, -1 if there is nothing.

    The base counts once its table of documents, which is written last, is complete. A run that fails before changes nothing, one that
    fails while deleting leaves folders that no reader opens and the next run deletes. No batch may be written meanwhile.
    """
    base, batches = _base(spark, index_path), _numbers(spark, f"{index_path}/documents", "batch")
    later = [n for n in batches if n > base]
    number = later[-1] if later else base
    if later:
        current_postings(spark, index_path).withColumn("part", F.pmod("doc_id", F.lit(64))).repartition("part", F.pmod(F.xxhash64("doc_id"), F.lit(8))).write.mode("overwrite").partitionBy("part").parquet(f"{index_path}/bases/postings={number}")
        documents = spark.read.schema("doc_id long").parquet(*(f"{index_path}/documents/batch={n}" for n in later), *([f"{index_path}/bases/documents={base}"] if base >= 0 else []))
        documents.distinct().write.mode("overwrite").parquet(f"{index_path}/bases/documents={number}")
    for kind in ("postings", "documents"):
        for folder, name in ((f"{index_path}/{kind}", "batch"), (f"{index_path}/bases", kind)):
            place, files = _folder(spark, folder)
            for f in files.listStatus(place) if files.exists(place) else []:
                known, _, n = f.getPath().getName().partition("=")
                if known == name and n.isdigit() and (int(n) <= number if name == "batch" else int(n) != number):
                    files.delete(f.getPath(), True)
    return number


def reindexed(documents: DataFrame, ledger: DataFrame, index_path: str, number: int, now: Column, task: str = "index") -> DataFrame:
    """Index the documents(doc_id, lang, source, text, modified) that the ledger says are due as batch number; returns the ledger with their runs.

    The ledger is to be stored after the batch; a batch that is run again, because it was not, writes the same.
    """
    rows = due(documents, ledger, task)
    batch = rows.select("doc_id", "lang", "source", "text")
    replace_documents(index_path)(batch, number)
    return recorded(ledger, rows.select("doc_id", now.alias("last_run")), task)
