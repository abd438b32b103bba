"""The registered queries: every operator over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docloom.functions.text import file_name, namespace
from docloom.operators import (
    bootstrap,
    chat,
    chunk,
    embed,
    evaluate,
    extract,
    infer,
    ivf,
    prompt,
    sql_search,
    text_search,
    vector,
)
from docloom.operators import index as index_ops
from docloom.plans import clients
from docloom.plans import tables as t
from docloom.session import materialise, new_folder, spread
from docloom.sources import files
from docloom.sources import tables as sinks
from docloom.streaming import feed, ingest

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

K = 3
SLOTS = 1 << 18
LSH_TABLES, LSH_WIDTH = 16, 4
IVF_CELLS, IVF_PROBES = 16, 12
#: Queries beyond these bytes meet the corpus in blocks.
QUERY_BYTES = 4_096
QUESTION = "the thing with that and station inon"


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def big(name: str):
    return F.col(name).cast("bigint")


# ---- sources, sinks, catalog


@query
def bronze_file_scan(spark, sf):
    """The pages as landed files, content and all."""
    return files.read_files(spark, t.landed_pages(spark, sf), "page-*").select(
        file_name(F.col("path")).alias("name"), "length", F.md5("content").alias("content_md5")
    )


def _schema(spark) -> str:
    app = "".join(c if c.isalnum() else "_" for c in spark.sparkContext.applicationId)
    return sinks.scratch_schema(spark, f"docloom_{app}")


@query
def bronze_overwrite_roundtrip(spark, sf):
    schema, bronze = _schema(spark), t.bronze_pages(spark, sf)
    sinks.overwrite_table(bronze.select("path", "length"), f"{schema}.bronze_roundtrip")
    back = sinks.overwrite_table(bronze, f"{schema}.bronze_roundtrip")
    return back.select("path", "length", F.md5("content").alias("content_md5"))


@query
def manifest_last_wins(spark, sf):
    return sinks.last_wins(t.manifest(spark, sf), "name", "ord")


@query
def landing_status(spark, sf):
    """Sources deliver files with the ids of their documents; pages' hosts are listed but deliver none."""
    docs = t.table(spark, sf, "documents").select("doc_id", "source")
    folder = new_folder(spark, "landing")
    lines = docs.select(F.col("doc_id").cast("string").alias("value"), F.col("source").alias("name"))
    # a few files per source, however many documents it has and tasks write them
    lines.repartition("name", F.pmod(F.xxhash64("value"), F.lit(4))).write.partitionBy("name").text(folder)
    landed = files.read_files(spark, folder, "*.txt").select(
        F.regexp_extract("path", "name=([^/]+)/", 1).alias("name"), "length"
    )
    sources = docs.select(F.col("source").alias("name"), F.concat(F.lit("documents/"), F.col("source")).alias("url"))
    host = F.regexp_extract("url", "^https?://([^/]+)", 1)
    hosts = t.table(spark, sf, "pages").select(host.alias("name"), F.concat(F.lit("//"), host).alias("url"))
    manifest = sources.unionByName(hosts).distinct()
    return files.landing_status(manifest, landed).select("name", "url", "status", "landed_bytes")


@query
def stage_counts(spark, sf):
    """Rows per stage, each counted while its table is written."""
    schema = _schema(spark)
    bronze, n_bronze = sinks.overwrite_counted(t.bronze_pages(spark, sf), f"{schema}.bronze")
    silver, n_silver = sinks.overwrite_counted(extract.silver(bronze), f"{schema}.silver")
    _, n_gold = sinks.overwrite_counted(chunk.gold(silver), f"{schema}.gold")
    counts = [("bronze", n_bronze), ("silver", n_silver), ("gold", n_gold)]
    return spark.createDataFrame(counts, "stage string, n bigint")


@query
def namespace_from_user(spark, sf):
    users = t.users(spark, sf).groupBy("user_name").agg(F.count(F.lit(1)).alias("n"))
    return users.withColumn("namespace", namespace(F.col("user_name")))


# ---- extraction


@query
def silver_extract_pages(spark, sf):
    return extract.silver(t.bronze_pages(spark, sf)).select(
        "path",
        F.col("doc_parsed_contents.num_pages").alias("num_pages"),
        F.col("doc_parsed_contents.parsed_content").alias("parsed_content"),
        "parser_status",
    )


@query
def silver_page_concat(spark, sf):
    """Conversations as documents, each turn a page."""
    pages = t.messages(spark, sf).withColumn("path", F.concat(F.lit("conv/"), F.col("conv_id").cast("string")))
    return extract.page_concat(pages, "path", "turn", "content")


@query
def silver_status_counts(spark, sf):
    return extract.status_counts(extract.silver(t.bronze_landed(spark, sf)))


# ---- chunking


def _document_silver(spark, sf) -> DataFrame:
    return t.document_silver(t.documents(spark, sf))


def _gold_columns(gold_df: DataFrame) -> DataFrame:
    return gold_df.select("path", "chunked_text", "chunk_id", big("chunk_pos").alias("chunk_pos"))


@query
def gold_boundary_chunks(spark, sf):
    return _gold_columns(chunk.gold(_document_silver(spark, sf)))


@query
def gold_fixed_chunks(spark, sf):
    return _gold_columns(chunk.gold(_document_silver(spark, sf), chunk.fixed_chunks()))


@query
def gold_chunk_stats(spark, sf):
    return chunk.chunk_stats(chunk.gold(_document_silver(spark, sf)))


@query
def gold_dropped_docs(spark, sf):
    silver = extract.silver(t.bronze_landed(spark, sf))
    return chunk.dropped_docs(silver, chunk.gold(silver, chunk.fixed_chunks()))


# ---- index and its changes


@query
def index_dedupe(spark, sf):
    return index_ops.build_index(t.gold_table(spark, sf))


@query
def gold_change_feed(spark, sf):
    return index_ops.change_feed(t.gold_version(spark, sf, 1), t.gold_version(spark, sf, 2))


@query
def index_apply_changes(spark, sf):
    old, new = t.gold_version(spark, sf, 1), t.gold_version(spark, sf, 2)
    changes = materialise(index_ops.change_feed(old, new), "feed")
    return index_ops.apply_changes(t.index_version(spark, sf, 1), new, changes)


@query
def stream_index_feed(spark, sf):
    """An index that follows the change feed of two gold versions as a stream, one after the other."""
    folder, out, checkpoint = (new_folder(spark, x) for x in ("gold-versions", "followed-index", "feed-checkpoint"))
    for number in (1, 2):
        # publishing writes it, so that it need not have been written before
        feed.publish(t.gold_of_version(spark, sf, number), folder)
        feed.follow(spark, folder, out, checkpoint)
    return feed.newest_index(spark, out)


@query
def stream_gold_chunks(spark, sf):
    """All documents arrive, then every tenth once more with another text."""
    arriving, out, checkpoint = (new_folder(spark, x) for x in ("arriving", "stream", "stream-checkpoint"))
    docs = t.documents(spark, sf).select("doc_id", "text")
    revised = docs.where("doc_id % 10 = 0").withColumn("text", F.concat(F.lit("Revised. "), "text"))
    for name, increment in (("first", docs), ("second", revised)):
        increment.write.parquet(f"{arriving}/{name}")
        stream = spark.readStream.schema(docs.schema).option("recursiveFileLookup", "true").parquet(arriving)
        ingest.stream_gold(stream, lambda df: t.document_silver(spread(df, "doc_id")), out, checkpoint)
    return _gold_columns(ingest.read_gold(spark, out))


# ---- retrieval


def _corpus(spark, sf) -> DataFrame:
    return t.table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").alias("v"))


def _ranked(df: DataFrame) -> DataFrame:
    return df.select("query_id", "rank", "id", "score")


@query
def knn_exact(spark, sf):
    """The vectors nearest to the mean vector of each label."""
    parts = t.table(spark, sf, "embeddings").select("label", F.posexplode("embedding").alias("pos", "x"))
    means = parts.groupBy("label", "pos").agg(F.avg(F.col("x").cast("double")).alias("x"))
    vectors = means.groupBy("label").agg(F.array_sort(F.collect_list(F.struct("pos", "x"))).alias("m"))
    queries = vectors.select(F.col("label").alias("query_id"), F.transform("m", lambda e: e["x"]).alias("v"))
    return _ranked(vector.knn_exact(queries, _corpus(spark, sf), K))


@query
def knn_lsh(spark, sf):
    """Near neighbours of every vector, by shared buckets; narrow ones, as these vectors' neighbours are 70 degrees away."""
    corpus = _corpus(spark, sf)
    queries = corpus.withColumnRenamed("id", "query_id")
    return _ranked(vector.knn_lsh(queries, corpus, K, LSH_TABLES, LSH_WIDTH))


def _every_fiftieth(spark, sf) -> DataFrame:
    return _corpus(spark, sf).where("id % 50 = 0").withColumnRenamed("id", "query_id")


@query
def knn_exact_each(spark, sf):
    """The vectors nearest to every vector whose id is divisible by 50, block by block."""
    return _ranked(vector.knn_exact(_every_fiftieth(spark, sf), _corpus(spark, sf), K, limit=QUERY_BYTES))


@query
def knn_ivf(spark, sf):
    """The same queries by cells and codes; most cells are looked into, as these vectors lie in no groups."""
    corpus = _corpus(spark, sf)
    index = ivf.build(corpus, IVF_CELLS)
    return _ranked(ivf.knn_ivf(_every_fiftieth(spark, sf), corpus, index, K, IVF_PROBES))


@query
def knn_ivf_recall(spark, sf):
    """What part of the exact hits the inverted file finds, and for what part of all pairs it needs full vectors."""
    corpus, queries = _corpus(spark, sf), _every_fiftieth(spark, sf)
    index = ivf.build(corpus, IVF_CELLS)
    found = ivf.knn_ivf(queries, corpus, index, K, IVF_PROBES).select("query_id", "id", F.lit(1).alias("found"))
    exact = vector.knn_exact(queries, corpus, K)
    pairs = F.lit(ivf.SHORTLIST) / F.lit(max(index.n, 1))
    return exact.join(found, ["query_id", "id"], "left").agg(
        F.count(F.lit(1)).alias("exact_hits"),
        F.round(F.count("found") / F.count(F.lit(1)), 6).alias("recall"),
        F.round(F.max(F.least(pairs, F.lit(1.0))), 6).alias("pairs_compared"),
    )


@query
def search_text_tfidf(spark, sf):
    return _ranked(text_search.search_text(t.questions(spark, sf), t.stored_documents(spark, sf), K))


def _hits(spark, sf, k: int = K, columns: tuple[str, ...] = ()) -> DataFrame:
    return text_search.retrieve(t.questions(spark, sf), t.index(spark, sf), t.stored_index(spark, sf), k, columns=columns)


@query
def search_top1(spark, sf):
    return _hits(spark, sf, 1).select("query_id", "chunked_text")


@query
def search_result_arrays(spark, sf):
    rows = text_search.result_arrays(_hits(spark, sf), ["chunk_id", "path"])
    lines = F.transform("data_array", lambda r: F.array_join(r, "|"))
    return rows.select("query_id", F.array_join(lines, ";").alias("data_array"))


@query
def retriever_docs(spark, sf):
    hits = _hits(spark, sf, 5, ("n_sources",))
    return hits.select("query_id", "rank", "chunk_id", "chunked_text", "path", "n_sources")


@query
def retriever_by_document(spark, sf):
    return text_search.by_document(_hits(spark, sf, 5))


@query
def search_collect_set(spark, sf):
    return text_search.text_set(_hits(spark, sf, 5))


@query
def search_function(spark, sf):
    sql_search.register(t.index(spark, sf), t.stored_index(spark, sf))
    return spark.sql(f"SELECT search_chunks('{QUESTION}') AS found")


@query
def search_table_function(spark, sf):
    sql_search.register(t.index(spark, sf), t.stored_index(spark, sf))
    return spark.sql(f"SELECT * FROM vector_search(query => '{QUESTION}', num_results => 5)")


@query
def rag_context(spark, sf):
    return text_search.context(_hits(spark, sf), t.questions(spark, sf))


@query
def search_no_hits(spark, sf):
    """Every question has a row, also one whose words no chunk holds."""
    asked = t.unanswerable(spark, sf)
    hits = text_search.retrieve(asked, t.index(spark, sf), t.stored_index(spark, sf), K)
    return text_search.context(hits, asked)


@query
def embed_chunks(spark, sf):
    done = embed.embed(t.index(spark, sf), clients.letters)
    parts = [F.col("embedding")[i].cast("bigint").alias(name) for i, name in enumerate(("chars", "spaces", "e"))]
    return done.select("chunk_id", *parts)


def _chunk_texts(spark, sf) -> DataFrame:
    return text_search.corpus_of(t.index(spark, sf))


@query
def embed_chunks_hashed(spark, sf):
    chunks = _chunk_texts(spark, sf)
    done = embed.embed_hashed(chunks, embed.fit(chunks, SLOTS), SLOTS)
    return done.select(F.col("id").alias("chunk_id"), "slot", F.round("weight", 6).alias("weight"))


@query
def search_embedded(spark, sf):
    """Questions and chunks embedded by one model, searched by embedding."""
    chunks, asked = _chunk_texts(spark, sf), t.questions(spark, sf).withColumnRenamed("query_id", "id")
    model = embed.fit(chunks, SLOTS)
    corpus, queries = embed.embed_hashed(chunks, model, SLOTS, nested=True), embed.embed_hashed(asked, model, SLOTS)
    size = model[1], embed.postings_of(model)
    return _ranked(embed.search_sparse(queries.withColumnRenamed("id", "query_id"), corpus, K, size))


# ---- prompts


@query
def prompt_instruction(spark, sf):
    p = prompt.instruct("Describe the tone of this message.", F.col("content"))
    return t.messages(spark, sf).select("conv_id", "turn", p.alias("prompt"))


@query
def prompt_labels(spark, sf):
    p = prompt.classify(F.col("content"), style="Explain your choice in the manner of a ship's captain.")
    return t.messages(spark, sf).select("conv_id", "turn", p.alias("prompt"))


@query
def prompt_stepwise(spark, sf):
    p = prompt.stepwise(F.col("content"))
    return t.messages(spark, sf).select("conv_id", "turn", p.alias("prompt"))


@query
def prompt_few_shot(spark, sf):
    """Which region a supplier's nation lies in, after three worked nations."""
    nation, region = t.table(spark, sf, "nation"), t.table(spark, sf, "region")
    examples = nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_nationkey").alias("ord"), F.col("n_name").alias("input"), F.col("r_name").alias("output")
    )
    asked = t.table(spark, sf, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    return prompt.few_shot(asked, "n_name", examples, 3).select("s_suppkey", "prompt")


@query
def prompt_context(spark, sf):
    p = prompt.with_context(F.col("question"), F.col("formatted_history"))
    return chat.state(t.messages(spark, sf)).select("conv_id", p.alias("prompt"))


@query
def route_requests(spark, sf):
    return _eval_set(spark, sf).select("prompt_id", prompt.route(F.col("prompt")).alias("route"))


@query
def label_parse(spark, sf):
    asked = t.messages(spark, sf).withColumn("prompt", prompt.classify(F.col("content")))
    done = infer.complete(asked, "prompt", clients.tone, period=infer.UNPACED)
    return done.select("conv_id", "turn", "text_output", prompt.parse_label(F.col("text_output")).alias("label"))


@query
def batch_complete(spark, sf):
    """Every message as a plain prompt, with one option for all calls and one that differs by row."""
    asked = t.messages(spark, sf).select(
        "conv_id", "turn", prompt.plain(F.col("content")).alias("prompt"), F.pmod("turn", F.lit(3)).alias("warmth")
    )
    options = {"options": {"max_tokens": 100}, "option_columns": {"temperature": "warmth"}}
    done = infer.complete(asked, "prompt", clients.digest, period=infer.UNPACED, **options)
    return done.select("conv_id", "turn", "text_output", "status")


@query
def batch_complete_paced(spark, sf):
    """The questions under one limit that four tasks share, half of them first, then all: a log keeps what was answered."""
    asked = t.questions(spark, sf).select("query_id", prompt.plain(F.col("text")).alias("prompt"))
    limits = {"calls": 20, "period": 1.0, "partitions": 4, "batch": 4, "log": new_folder(spark, "responses")}
    infer.complete(asked.where("query_id % 2 = 0"), "prompt", clients.digest, **limits)
    done = infer.complete(asked, "prompt", clients.digest, **limits)
    return done.select("query_id", "text_output", "status")


# ---- conversations


@query
def chat_question(spark, sf):
    return chat.question(t.messages(spark, sf))


@query
def chat_history(spark, sf):
    return chat.history(t.messages(spark, sf))


@query
def chat_formatted_history(spark, sf):
    return chat.state(t.messages(spark, sf)).select("conv_id", "n_messages", "formatted_history")


@query
def chat_rewrite_prompt(spark, sf):
    p = chat.rewrite_prompt(F.col("chat_history"), F.col("question"))
    return chat.state(t.messages(spark, sf)).where("n_messages > 1").select("conv_id", p.alias("prompt"))


@query
def chat_search_query(spark, sf):
    done = chat.search_query(chat.state(t.messages(spark, sf)), clients.echo, period=infer.UNPACED)
    return done.select("conv_id", "question", "search_query")


@query
def chat_generation_messages(spark, sf):
    """With the best chunk for each conversation's last message as context."""
    messages = t.messages(spark, sf)
    asked = chat.question(messages).select(F.col("conv_id").alias("query_id"), F.col("question").alias("text"))
    hits = text_search.retrieve(asked, t.index(spark, sf), t.stored_index(spark, sf), 1)
    contexts = text_search.context(hits, asked).withColumnRenamed("query_id", "conv_id")
    return chat.generation_messages(messages, contexts.select("conv_id", "context"))


@query
def rag_batch(spark, sf):
    done = chat.answer(
        t.messages(spark, sf), t.index(spark, sf), t.stored_index(spark, sf), clients.echo, K, period=infer.UNPACED
    )
    return done.drop("context")


# ---- evaluation


def _eval_set(spark, sf) -> DataFrame:
    return evaluate.eval_set(diagnostic=t.requests(spark, sf), adversarial=t.demands(spark, sf))


@query
def eval_set_union(spark, sf):
    return _eval_set(spark, sf)


@query
def eval_requests_as_chat(spark, sf):
    return chat.from_requests(_eval_set(spark, sf), "prompt_id", "prompt")


@query
def eval_bulk_run(spark, sf):
    return _run(spark, sf).select("prompt_id", "kind", "prompt", "text_output", "status")


def _run(spark, sf) -> DataFrame:
    return evaluate.bulk_run(_eval_set(spark, sf), clients.telephone, period=infer.UNPACED)


def _judged(spark, sf) -> DataFrame:
    return evaluate.judge(_run(spark, sf))


@query
def eval_judge(spark, sf):
    return _judged(spark, sf).select("prompt_id", *evaluate.CRITERIA)


@query
def eval_judge_client(spark, sf):
    judged = evaluate.judge_by_client(_run(spark, sf), clients.strict, period=infer.UNPACED)
    return judged.select("prompt_id", *evaluate.CRITERIA)


@query
def eval_summary(spark, sf):
    return evaluate.summary(_judged(spark, sf))


@query
def eval_intervals(spark, sf):
    """The pass rates of ``eval_summary`` with their 95 % intervals."""
    return bootstrap.intervals(_judged(spark, sf), "prompt_id", list(evaluate.CRITERIA), "kind")


@query
def eval_rag(spark, sf):
    """The questions run through the whole chain, and whether each answer rests on what was retrieved."""
    asked = chat.from_requests(t.questions(spark, sf), "query_id", "text")
    done = chat.answer(
        asked, t.index(spark, sf), t.stored_index(spark, sf), clients.reader, K, period=infer.UNPACED
    )
    return evaluate.grounded(done).select("conv_id", "n_docs", "sources", "answer", "grounded")


@query
def eval_retrieval(spark, sf):
    asked = t.questions(spark, sf)
    hits = text_search.search_text(asked, t.stored_documents(spark, sf), 5)
    return evaluate.retrieval_quality(asked, hits, evaluate.truth(asked, t.document_corpus(spark, sf)))
