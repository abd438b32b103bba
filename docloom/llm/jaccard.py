"""Similarity join of documents on their word n-grams: MinHash bands, then full sets.

Documents with equal n-gram sets are one text. Signatures are cut into bands; the numbers of bands
and of rows in a band are the cheapest that find a pair at the threshold with the wanted
probability. Texts are shuffled by the hash of each band, and texts that share one are candidates.
A candidate pair belongs to the first band it shares, so that no list of pairs has to be made
unique, and is verified on the full sets.

Large buckets are dealt into blocks, and every two blocks meet in a group of their own:
no group exceeds two blocks, whatever the bucket, and all pairs in it are still compared.
Groups give sums and spanning links per text, never pairs. Sets travel only to the groups where
their text has a candidate, found by bands and sizes alone.

Texts without words have no n-grams and no links; those of one to four words have one n-gram.
Null texts are without words. Null ids are ids of their own, class ids ignore them. Repeated rows
are copies. Every row gives a row, an empty table none; only the named columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm import shingles, vocab
from docloom.llm.components import components
from docloom.llm.filtering import key_of, stay
from docloom.llm.storage import keep
from docloom.llm.worker import release
from docloom.session import broadcast_if_small

THRESHOLD = 0.8
RECALL = 0.9999
MOST_HASHES = 128
BLOCK = 128
COLUMNS = 4_000_000


def bands_for(threshold: float = THRESHOLD, recall: float = RECALL, most: int = MOST_HASHES) -> tuple[int, int]:
    """(bands, rows): the most rows in a band, and then the fewest bands, that reach ``recall`` at ``threshold``."""
    best = None
    for rows in range(1, most + 1):
        bands = int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))
        if bands * rows > most:
            break
        best = bands, rows
    if not best:
        raise ValueError(f"{most} hashes do not reach a recall of {recall} at {threshold}")
    return best


def band_hashes(numbers: np.ndarray, before: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """A number per band for every set; sets are neighbours in ``numbers`` and not empty."""
    steps = np.arange(1, bands * rows + 1, dtype=np.uint64)
    factor = shingles.mixed(steps * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    out = np.zeros((len(before) - 1, bands), np.uint64)
    for band in range(bands):
        total = np.zeros(len(before) - 1, np.uint64)
        for i in range(band * rows, (band + 1) * rows):
            hashed = ((numbers * factor[i]) >> np.uint64(32)).astype(np.uint32)
            total = total * np.uint64(0xC2B2AE3D27D4EB4F) + np.minimum.reduceat(hashed, before[:-1])
        out[:, band] = shingles.mixed(total)
    return out


def signatures(docs: DataFrame, bands: int, rows: int, n: int = shingles.N) -> DataFrame:
    """_row, _id, _key as in ``docs``, and _set (16 bytes, null for no n-grams), _n, _bands."""

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, numbers, before in shingles.sets(vocab.texts_of(batch.column(3)), n):
                size = np.diff(before)
                some = np.flatnonzero(size)
                hashes = np.zeros((b - a, bands), np.uint64)
                if len(some):
                    hashes[some] = band_hashes(numbers, np.append(before[some], before[-1]), bands, rows)
                digests = [
                    xxhash.xxh3_128_digest(numbers[before[i] : before[i + 1]]) if size[i] else None for i in range(b - a)
                ]
                part = batch.slice(a, b - a)
                lists = pa.ListArray.from_arrays(
                    pa.array(np.arange(b - a + 1) * bands, pa.int32()), pa.array(hashes.ravel().view(np.int64))
                )
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array(digests, pa.binary()), pa.array(size, pa.int64()), lists],
                    names=["_row", "_id", "_key", "_set", "_n", "_bands"],
                )
        release()

    kind = docs.schema["_id"].dataType.simpleString()
    return docs.mapInArrow(sign, f"_row bigint, _id {kind}, _key string, _set binary, _n bigint, _bands array<bigint>")


def runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[pa.Table]:
    """Neighbouring rows with equal first ``keys`` columns, run by run, across batches."""
    held: list[pa.RecordBatch] = []
    last = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.stack([batch.column(i).to_numpy() for i in range(keys)])
        first = np.flatnonzero(np.append(True, (columns[:, 1:] != columns[:, :-1]).any(axis=0)))
        for a, b in zip(first, [*first[1:], batch.num_rows]):
            key = tuple(columns[:, a])
            if held and key != last:
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
            last = key
    if held:
        yield pa.Table.from_batches(held)


def matrix(table: pa.Table, column: str) -> np.ndarray:
    return table[column].combine_chunks().flatten().to_numpy().reshape(table.num_rows, -1)


def due(table: pa.Table, threshold: float) -> np.ndarray:
    """Which pairs of a group are to be compared there, as a matrix over its rows, above the diagonal."""
    band, block = table["band"][0].as_py(), table["block"].to_numpy()
    one, two = table["one"][0].as_py(), table["two"][0].as_py()
    hashes, n = matrix(table, "_bands"), table["_n"].to_numpy()
    pair = np.triu(np.ones((len(n), len(n)), bool), 1)
    if one != two:
        pair &= block[:, None] != block[None, :]
    pair &= np.minimum(n[:, None], n[None, :]) >= threshold * np.maximum(n[:, None], n[None, :]) - 1e-9
    pair &= hashes[:, None, band] == hashes[None, :, band]
    for earlier in range(band):
        pair &= hashes[:, None, earlier] != hashes[None, :, earlier]
    return pair


def shared(numbers: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """The sizes of all intersections of sets that lie in a row."""
    m = len(ends)
    owner = np.repeat(np.arange(m), np.diff(ends, prepend=0))
    order = np.argsort(numbers, kind="stable")
    first = np.append(True, numbers[order][1:] != numbers[order][:-1])
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(first) - 1
    many = np.bincount(place) > 1
    column = (np.cumsum(many) - 1)[place]
    chosen = many[place]
    owner, column, total = owner[chosen], column[chosen], int(many.sum())
    out = np.zeros((m, m), np.float32)
    step = max(1, COLUMNS // m)
    for low in range(0, total, step):
        inside = (column >= low) & (column < low + step)
        x = np.zeros((m, min(step, total - low)), np.float32)
        x[owner[inside], column[inside] - low] = 1
        out += x @ x.T
    return out


def verified(table: pa.Table, threshold: float) -> list[tuple]:
    """(text, linked documents, linked texts, smallest text linked in this group) of a group's linked texts."""
    sets = table["numbers"].combine_chunks()
    numbers = sets.flatten().to_numpy()
    n = np.diff(sets.offsets.to_numpy())
    common = shared(numbers, np.cumsum(n))
    union = n[:, None] + n[None, :] - common
    links = due(table, threshold) & (common >= threshold * union - 1e-6)
    if not links.any():
        return []
    links |= links.T
    weight, names = table["weight"].to_numpy(), table["_set"].to_pylist()
    root = np.array(sorted(range(len(n)), key=names.__getitem__)).argsort()
    while True:
        least = np.minimum(root, np.where(links, root[None, :], len(n)).min(axis=1))
        if (least == root).all():
            break
        root = least
    by_rank = sorted(names)
    linked = np.flatnonzero(links.any(axis=1))
    return [(names[i], int(weight[links[i]].sum()), int(links[i].sum()), by_rank[root[i]]) for i in linked]


KEYS = ["bucket", "one", "two"]


def dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition(*KEYS).sortWithinPartitions(*KEYS)


def members(texts: DataFrame, block: int) -> DataFrame:
    """bucket, one, two, band, block, _set, _n, weight, _bands: texts in groups of two blocks of a shared bucket."""
    spread = texts.select("_set", F.posexplode("_bands").alias("band", "hash"))
    buckets = spread.select("_set", "band", F.xxhash64("band", "hash").alias("bucket"))
    shared_by = keep(
        buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1"), "shared-buckets"
    )
    found = (
        texts.select("_set", "_n", "weight", "_bands", F.posexplode("_bands").alias("band", "hash"))
        .withColumn("bucket", F.xxhash64("band", "hash"))
        .join(broadcast_if_small(shared_by), "bucket")
    )
    blocks = F.ceil(F.col("size") / F.lit(block)).cast("int")
    own = F.pmod(F.xxhash64("_set", "bucket"), F.col("blocks")).cast("int")
    met = found.withColumn("blocks", blocks).withColumn("block", own)
    groups = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return groups.select(
        "bucket",
        F.least("block", "other").alias("one"),
        F.greatest("block", "other").alias("two"),
        "band",
        "block",
        "_set",
        "_n",
        "weight",
        "_bands",
    )


def full_sets(docs: DataFrame, wanted: DataFrame, n: int) -> DataFrame:
    """_set, numbers: the n-grams of the texts in ``wanted`` (_key, _set), read again from one document each."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, numbers, before in shingles.sets(vocab.texts_of(batch.column(1)), n):
                lists = pa.ListArray.from_arrays(pa.array(before, pa.int32()), pa.array(numbers.view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), lists], names=["_set", "numbers"])

    chosen = docs.select("_key", "_text").join(broadcast_if_small(wanted), "_key").select("_set", "_text")
    sets = keep(chosen.mapInArrow(read, "_set binary, numbers array<bigint>"), "full-sets")
    # documents that repeat id and text would give a set twice
    twice = sets.groupBy("_set").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("_set")
    if not twice.isEmpty():
        once = sets.join(twice, "_set", "left_semi").groupBy("_set").agg(F.first("numbers").alias("numbers"))
        sets = sets.join(twice, "_set", "left_anti").unionByName(once)
    return sets


def classes(
    docs: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    n: int = shingles.N,
    block: int = BLOCK,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, class_id, n_links, n_linked_texts, kept, _key for every document.

    ``class_id`` is the smallest id of the documents connected by links, ``n_links`` counts the other
    documents of similarity ``threshold`` or more, ``n_linked_texts`` the different n-gram sets
    among them. One document of a class is ``kept``, that with the smallest id.
    """
    bands, rows = bands_for(threshold, recall)
    own = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).alias("_id"),
        key_of(id_col, text_col).alias("_key"),
        F.col(text_col).alias("_text"),
    )
    signed = keep(signatures(own, bands, rows, n), "signatures")
    some = signed.where(F.col("_set").isNotNull())
    first = F.struct(F.col("_id").isNull().alias("unknown"), F.col("_id").alias("id"), F.col("_row").alias("row"))
    texts = keep(
        some.groupBy("_set").agg(
            F.count(F.lit(1)).alias("weight"),
            F.min(first).alias("_first"),
            F.min("_key").alias("_key"),
            F.first("_n").alias("_n"),
            F.first("_bands").alias("_bands"),
        ),
        "texts",
    )
    groups = keep(members(texts, block), "bucket-members")

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, len(KEYS)):
            pairs = due(table, threshold)
            needed = pairs.any(axis=0) | pairs.any(axis=1)
            if needed.any():
                yield from table.filter(pa.array(needed)).combine_chunks().to_batches()

    routed = keep(dealt(groups).mapInArrow(route, groups.schema), "routed-members")
    wanted = texts.join(routed.select("_set").distinct(), "_set", "left_semi").select("_key", "_set")
    sets = full_sets(own, keep(wanted, "texts-to-verify"), n)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in runs(batches, len(KEYS)):
            if found := verified(table, threshold):
                columns = list(zip(*found))
                kinds = (pa.binary(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, k) for c, k in zip(columns, kinds)], names=["_set", "links", "texts", "root"]
                )
        release()

    met = dealt(routed.join(sets, "_set").select(*KEYS, "band", "block", "_set", "_n", "weight", "_bands", "numbers"))
    found = keep(met.mapInArrow(verify, "_set binary, links bigint, texts bigint, root binary"), "verified")
    labels = components(found.select(F.col("_set").alias("a"), F.col("root").alias("b")))
    totals = found.groupBy("_set").agg(F.sum("links").alias("links"), F.sum("texts").alias("n_texts"))
    named = texts.select("_set", "weight", "_first").join(labels.withColumnRenamed("node", "_set"), "_set", "left").join(
        totals, "_set", "left"
    )
    labelled = keep(named.withColumn("label", F.coalesce("label", "_set")), "labelled-texts")
    heads = keep(labelled.groupBy("label").agg(F.min("_first").alias("_head")), "class-heads")
    facts = keep(labelled.join(heads, "label").select("_set", "weight", "_head", "links", "n_texts"), "text-classes")
    alone = F.col("weight").isNull()
    return signed.select("_row", "_id", "_key", "_set").join(facts, "_set", "left").select(
        F.col("_id").alias(id_col),
        F.when(alone, F.col("_id")).otherwise(F.col("_head.id")).alias("class_id"),
        (F.coalesce("weight", F.lit(1)) - 1 + F.coalesce("links", F.lit(0))).cast("bigint").alias("n_links"),
        F.coalesce("n_texts", F.lit(0)).cast("bigint").alias("n_linked_texts"),
        (alone | (F.col("_row") == F.col("_head.row"))).alias("kept"),
        "_key",
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``docs`` with one document of each class."""
    found = classes(docs, id_col=id_col, text_col=text_col, **options)
    return stay(docs, found, key_of(id_col, text_col))
