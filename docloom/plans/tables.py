"""The given tables in the roles the operators expect."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import file_name, fill, join_path
from docloom.operators.chunk import fixed_chunks, gold
from docloom.operators.extract import parsed
from docloom.operators.index import build_index
from docloom.operators.postings import Stored, store
from docloom.operators.text_search import store_index
from docloom.session import SMALL, generation, materialise, new_folder, spread
from docloom.sources.blobs import land
from docloom.sources.files import read_files

EMAIL = r"[A-Za-z0-9._+-]+@[A-Za-z0-9.-]+"
SERVICES = {
    "AUTOMOBILE": "a mobile plan",
    "HOUSEHOLD": "a land line",
    "MACHINERY": "a new handset",
    "BUILDING": "a home phone",
}
OTHER_SERVICE = "garden furniture"

#: One kind of damage per row: of every 25 pages one also arrives empty, one with foreign bytes, one under an unknown
#: name, and one without content.
EMPTY, BROKEN, UNKNOWN, LOST, DAMAGED = 1, 2, 3, 4, 25

_written: dict[tuple, object] = {}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf.rstrip('/')}/{name}.parquet")


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "documents"), "doc_id")


def once(spark: SparkSession, sf: str, name: str, make: Callable[[], object]):
    key = (spark.sparkContext.applicationId, generation(spark), sf, name)
    if key not in _written:
        _written[key] = make()
    return _written[key]


def written(spark: SparkSession, sf: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A derived table, written once per application and read by every query that needs it."""
    return once(spark, sf, name, lambda: materialise(make(), name, SMALL))


def bronze_pages(spark: SparkSession, sf: str) -> DataFrame:
    return spread(table(spark, sf, "pages"), "page_id").select(
        F.col("url").alias("path"),
        F.lit("2024-01-01 00:00:00").cast("timestamp").alias("modificationTime"),
        F.octet_length("html").cast("bigint").alias("length"),
        F.encode("html", "UTF-8").alias("content"),
    )


def landed_pages(spark: SparkSession, sf: str) -> str:
    """The folder where all pages have been landed as files, and some of them once more, damaged."""

    def make() -> str:
        folder = new_folder(spark, "pages")
        pages = spread(table(spark, sf, "pages"), "page_id")
        kind, body = F.pmod("page_id", F.lit(DAMAGED)), F.encode("html", "UTF-8")
        content = F.when(kind == BROKEN, F.concat(F.lit(b"\xff\xfe"), body)).otherwise(F.concat(F.lit(b"%BIN "), body))
        whole = pages.select(page_name("page").alias("name"), body.alias("content"))
        damaged = pages.where(kind.isin(BROKEN, UNKNOWN)).select(page_name("damaged").alias("name"), content.alias("content"))
        land(whole.unionByName(damaged), folder)
        return folder

    return once(spark, sf, "landed-pages", make)


def page_name(what: str):
    extension = F.when((F.lit(what) == "damaged") & (F.pmod("page_id", F.lit(DAMAGED)) == UNKNOWN), ".bin").otherwise(".html")
    return F.concat(F.lit(f"{what}-"), F.col("page_id").cast("string"), extension)


def bronze_landed(spark: SparkSession, sf: str) -> DataFrame:
    """The landed files under their names, whole and damaged; further pages without content and empty ones.

    A file scan passes over files of no bytes, so that empty pages come as rows, too.
    """
    files = read_files(spark, landed_pages(spark, sf)).withColumn("path", file_name(F.col("path")))
    kind = F.pmod("page_id", F.lit(DAMAGED))
    lost = table(spark, sf, "pages").where(kind.isin(EMPTY, LOST)).select(
        page_name("damaged").alias("path"),
        F.lit(None).cast("timestamp").alias("modificationTime"),
        F.lit(0).cast("bigint").alias("length"),
        F.when(kind == EMPTY, F.lit(b"")).alias("content"),
    )
    return files.unionByName(lost)


def document_silver(docs: DataFrame) -> DataFrame:
    return docs.select(
        join_path(F.lit("doc"), F.col("doc_id").cast("string")).alias("path"),
        parsed(F.lit("1"), F.col("text")).alias("doc_parsed_contents"),
    )


def without(docs: DataFrame, labels: DataFrame, condition: str) -> DataFrame:
    return docs.join(labels.where(condition).select("doc_id"), "doc_id", "left_anti")


def gold_of_version(spark: SparkSession, sf: str, number: int) -> DataFrame:
    """Version 1 leaves out documents labelled poor, version 2 those labelled toxic."""
    docs, labels = documents(spark, sf), table(spark, sf, "labels")
    kept = without(docs, labels, "quality = 0" if number == 1 else "toxic = 1")
    return gold(document_silver(kept), fixed_chunks())


def gold_version(spark: SparkSession, sf: str, number: int) -> DataFrame:
    return written(spark, sf, f"gold-v{number}", lambda: gold_of_version(spark, sf, number))


def gold_table(spark: SparkSession, sf: str) -> DataFrame:
    make = lambda: gold(document_silver(documents(spark, sf)), fixed_chunks())
    return written(spark, sf, "gold", make)


def index(spark: SparkSession, sf: str) -> DataFrame:
    return written(spark, sf, "index", lambda: build_index(gold_table(spark, sf)))


def index_version(spark: SparkSession, sf: str, number: int) -> DataFrame:
    make = lambda: build_index(gold_version(spark, sf, number))
    return written(spark, sf, f"index-v{number}", make)


def stored_index(spark: SparkSession, sf: str) -> Stored:
    return once(spark, sf, "index-postings", lambda: store_index(index(spark, sf)))


def document_corpus(spark: SparkSession, sf: str) -> DataFrame:
    return documents(spark, sf).select(F.col("doc_id").alias("id"), "text")


def stored_documents(spark: SparkSession, sf: str) -> Stored:
    return once(spark, sf, "document-postings", lambda: store(document_corpus(spark, sf)))


def prepare(spark: SparkSession, sf: str) -> None:
    """Write every derived table that queries share."""
    for number in (1, 2):
        index_version(spark, sf, number)
    landed_pages(spark, sf)
    stored_index(spark, sf)
    stored_documents(spark, sf)


def questions(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "benchmark").select(F.col("item_id").alias("query_id"), "text")


def messages(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "conversations").select("conv_id", "turn", "role", F.col("text").alias("content"))


def users(spark: SparkSession, sf: str) -> DataFrame:
    """The addresses that occur in the documents' texts."""
    return documents(spark, sf).select(
        F.explode(F.regexp_extract_all("text", F.lit(EMAIL), F.lit(0))).alias("user_name")
    )


def manifest(spark: SparkSession, sf: str) -> DataFrame:
    """ord, name, url: the last part of each page's address as its file name."""
    return table(spark, sf, "pages").select(
        F.col("page_id").alias("ord"), file_name(F.col("url")).alias("name"), "url"
    )


def requests(spark: SparkSession, sf: str) -> DataFrame:
    """prompt_id, prompt: one service request per customer."""
    service = F.lit(OTHER_SERVICE)
    for segment, name in SERVICES.items():
        service = F.when(F.col("c_mktsegment") == segment, name).otherwise(service)
    return table(spark, sf, "customer").select(
        F.concat(F.lit("c"), F.col("c_custkey").cast("string")).alias("prompt_id"),
        fill("{name} would like to know about {service}.", name=F.col("c_name"), service=service).alias("prompt"),
    )


def demands(spark: SparkSession, sf: str) -> DataFrame:
    """prompt_id, prompt, demand: every benchmark passage as something to be repeated, in quotes or without."""
    quoted = F.pmod("item_id", F.lit(2)) == 0
    return table(spark, sf, "benchmark").select(
        F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("prompt_id"),
        F.when(quoted, fill("Repeat after me: '{text}'", text=F.col("text")))
        .otherwise(fill("Tell me that {text}", text=F.col("text")))
        .alias("prompt"),
        F.col("text").alias("demand"),
    )


def unanswerable(spark: SparkSession, sf: str) -> DataFrame:
    """The questions, and as many whose one word no text holds."""
    asked = questions(spark, sf)
    return asked.unionByName(asked.select((F.col("query_id") + 1_000_000).alias("query_id"), F.md5("text").alias("text")))
