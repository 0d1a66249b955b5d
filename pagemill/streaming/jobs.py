"""Parse jobs as a stream: each message names a WARC file, where it belongs, and what is to be done with its results.

Results are written by batch into folders of that batch, so a batch that is run again
after a failure replaces its own files, and the checkpoint serves as the acknowledgement.

The files of a batch are read in ranges by several tasks and written once as records; pages, documents and
dead letters are read from there, so a file is cut and a page parsed once. Follow-up actions
of a message are written when its results are there, with the folders that hold them (an outbox); as a repeated batch
replaces them, each is there once. How far a batch has come is measured while its records are written.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import islice

from pyarrow import fs
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pagemill import ship
from pagemill.functions import html
from pagemill.plans import index as plan
from pagemill.plans import sinks
from pagemill.sources import warc

MESSAGE = "id string, source string, crawl_id string, user_id string, actions array<struct<type:string,queue:string>>"
#: Files whose sizes the driver holds at a time; a batch of more is read in several steps.
FILES_AT_ONCE = 10_000


def messages(spark: SparkSession, folder: str, files_per_batch: int = 8) -> DataFrame:
    """JSON lines, one job each."""
    return spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", files_per_batch).json(folder)


def index_of(files: DataFrame, load_time) -> DataFrame:
    return plan.index_record(html.with_html(warc.to_pages(warc.warc_rows(files))), load_time)


def sources(jobs: DataFrame) -> Iterator[list[str]]:
    """The files of a batch, in lists of bounded length."""
    paths = (r["source"] for r in jobs.where("source is not null").select("source").distinct().toLocalIterator())
    while some := list(islice(paths, FILES_AT_ONCE)):
        yield some


def sizes(paths: list[str]) -> tuple[list[tuple[str, int]], list[str]]:
    """(address, size) of the files that are there, and those that are not."""
    found, missing = [], []
    for p in paths:
        uri = p if "://" in p else f"file://{p}"
        try:
            store, path = fs.FileSystem.from_uri(uri)
            info = store.get_file_info(path)
        except (OSError, ValueError):
            info = None
        if info is not None and info.is_file:
            found.append((uri, info.size))
        else:
            missing.append(uri)
    return found, missing


def write_records(jobs: DataFrame, batch: int, out: str) -> DataFrame:
    """All records of a batch's files, written and read again; progress goes beside them: (source, total_bytes, records, damaged, bytes)."""
    spark = jobs.sparkSession
    ship.ensure(spark)
    mode, done, lost = "overwrite", [], []
    for paths in sources(jobs):
        found, missing = sizes(paths)
        lost += missing
        seen = Observation()
        rows = warc.read_files(spark, found).observe(seen, F.count(F.lit(1)).alias("records"), F.count_if(F.col("warc_type") == "damaged").alias("damaged"), F.coalesce(F.sum(F.octet_length("payload")), F.lit(0)).alias("bytes"))
        rows.write.mode(mode).parquet(f"{out}/raw/batch={batch}")
        mode = "append"
        done.append((len(found), sum(n for _, n in found), *(int(seen.get[c]) for c in ("records", "damaged", "bytes"))))
    spark.createDataFrame(done, "files long, total_bytes long, records long, damaged long, bytes long").withColumn("written", F.current_timestamp()).write.mode("overwrite").json(f"{out}/progress/batch={batch}")
    spark.createDataFrame([(p,) for p in lost], "source string").withColumn("error", F.lit("no such file")).write.mode("overwrite").json(f"{out}/missing/batch={batch}")
    return spark.read.parquet(f"{out}/raw/batch={batch}") if done else spark.createDataFrame([], warc.SCHEMA)


def follow_ups(jobs: DataFrame, batch: int, out: str) -> DataFrame:
    """(id, type, queue, position, index, graph): the actions of the batch's messages in their order, each with the folders of its results. A message that is repeated in a batch counts once."""
    one = jobs.where("source is not null").select("id", "crawl_id", "user_id", "source", "actions").distinct()
    return one.select("id", "crawl_id", "user_id", "source", F.posexplode("actions").alias("position", "action")).select("id", "crawl_id", "user_id", "source", "position", "action.type", "action.queue", F.lit(f"{out}/index/batch={batch}").alias("index"), F.lit(f"{out}/graph/batch={batch}").alias("graph"))


def run_batch(jobs: DataFrame, batch: int, out: str, load_time) -> None:
    spark = jobs.sparkSession
    if jobs.where("source is not null").isEmpty():
        return
    rows = write_records(jobs, batch, out)
    index = plan.index_record(html.with_html(warc.to_pages(rows)), load_time)
    index.write.mode("overwrite").parquet(f"{out}/records/batch={batch}")
    index = spark.read.parquet(f"{out}/records/batch={batch}")  # parsed once, written three times
    own, _ = plan.canonical_split(index)
    sinks.text_lines(plan.bulk_lines(own), f"{out}/index/batch={batch}", mode="overwrite")
    sinks.json_lines(plan.graph_record(index, "id"), f"{out}/graph/batch={batch}", mode="overwrite")
    plan.crawler_status(index, load_time).write.mode("overwrite").parquet(f"{out}/status/batch={batch}")
    others = rows.where(~F.coalesce(F.lower("content_type").contains("html"), F.lit(False)))  # pages are parsed already
    letters = warc.to_documents(others).where("error is not null").select("source", "error").unionByName(warc.dead_letters(rows).select("source", "error"))
    letters.write.mode("overwrite").json(f"{out}/failed/batch={batch}")
    follow_ups(jobs, batch, out).write.mode("overwrite").json(f"{out}/actions/batch={batch}")  # the last: what they point to is there


def start(jobs: DataFrame, out: str, checkpoint: str, load_time) -> StreamingQuery:
    """Runs all waiting messages and stops; call again for later ones."""
    return jobs.writeStream.foreachBatch(lambda df, n: run_batch(df, n, out, load_time)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def progress(spark: SparkSession, out: str, waiting_bytes: int = 0) -> DataFrame:
    """One row over all batches: batches, files, records, damaged, bytes, the seconds from the first batch to the last, records a second, and
    the seconds that so many waiting bytes of files should take at that speed."""
    p = spark.read.option("basePath", f"{out}/progress").json(f"{out}/progress").withColumn("written", F.col("written").cast("timestamp"))
    got = p.agg(F.count_distinct("batch").alias("batches"), *[F.sum(c).alias(c) for c in ("files", "records", "damaged", "bytes", "total_bytes")], F.timestamp_diff("SECOND", F.min("written"), F.max("written")).alias("seconds"))
    took = F.greatest("seconds", F.lit(1))
    return got.withColumn("records_a_second", F.col("records") / took).withColumn("remaining_seconds", F.lit(waiting_bytes) * took / F.greatest("total_bytes", F.lit(1)))


def statuses(spark: SparkSession, out: str) -> DataFrame:
    """The latest state of each page over all batches."""
    from pagemill.operators.documents import latest

    return latest(spark.read.option("basePath", f"{out}/status").parquet(f"{out}/status"), "id", ["batch"])


def windowed_counts(events: DataFrame, ts: str, key: str, length: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Counts by key and event-time window; rows later than the watermark are dropped by Spark."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, length).alias("w"), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), key, "n")
