"""Hard negatives for anchors by exact integer inner products in Kronecker-packed products.

Components become integers. Those of the rows of a block are made non-negative by a bias and
written side by side into fields of one wide integer per component, so that an anchor costs one
multiplication per component for the whole block: fields of the sum hold the products of all
rows, wide enough that none runs over, and the biases are taken off again.

Blocks of anchors meet blocks of rows in groups of bounded size, once to find each anchor's positives and
once to find the negatives of its positives; every group keeps a few hits per question.

Rows with a null id, label or vector, or a component that is null or not finite, take no part. Shorter vectors count
as if zeros followed. Components are held within bounds that keep every product within 64 bits, some 2 ** 27 for
64 of them. Rows that repeat an id are rows of their own: each is an anchor, and each can be found. An anchor without
positives, or positives without negatives, give no rows; neither do empty tables. Only the named
columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docloom.llm.storage import keep
from docloom.llm.worker import release

POSITIVES, NEGATIVES = 5, 10
#: Bounds of a negative's product as percent of the positive's.
LOWEST, HIGHEST = 30, 90
SCALE = 256
ANCHOR_BLOCK, ROW_BLOCK = 8_192, 4_096
#: Rows in one wide integer.
FIELDS = 512
#: Products held at a time.
CELLS = 2_000_000


class Packed:
    """Rows of non-negative integers as one wide integer per component, a field for each row."""

    def __init__(self, rows: np.ndarray, bias: int, most: int):
        """``rows`` plus ``bias`` lie between 0 and ``most``, and so do those that they will be multiplied with."""
        self.n, size = rows.shape
        self.bias, self.size = bias, size
        self.words = -(-max(1, (size * most * most).bit_length()) // 32)
        raised = (rows + bias).astype(np.uint64)
        fields = np.zeros((size, self.n, max(2, self.words)), "<u4")
        fields[:, :, 0] = (raised & np.uint64(0xFFFFFFFF)).T
        fields[:, :, 1] = (raised >> np.uint64(32)).T
        fields = fields[:, :, : self.words]
        self.wide = [int.from_bytes(np.ascontiguousarray(fields[d]).tobytes(), "little") for d in range(size)]
        self.sums = rows.sum(axis=1)

    def products(self, anchors: np.ndarray) -> np.ndarray:
        """anchors x rows: exact inner products, which must fit into 64 bits."""
        out = np.empty((len(anchors), self.n), np.int64)
        length = 4 * self.words * self.n
        # arithmetic modulo 2 ** 64 is enough, as what is left in the end fits
        rest = self.sums.astype(np.uint64) * np.uint64(self.bias) + np.uint64(self.size * self.bias**2 % (1 << 64))
        for i, anchor in enumerate(anchors):
            raised = (anchor + self.bias).tolist()
            total = sum(map(mul, raised, self.wide)).to_bytes(length, "little")
            fields = np.frombuffer(total, "<u4").reshape(self.n, self.words)
            low = fields[:, 0].astype(np.uint64)
            if self.words > 1:
                low |= fields[:, 1].astype(np.uint64) << np.uint64(32)
            out[i] = (low - rest - np.uint64(self.bias * int(anchor.sum()) % (1 << 64))).view(np.int64)
        return out


class Best:
    """The k highest (score, smallest id, smallest row) per question."""

    def __init__(self, questions: int, k: int):
        self.k = k
        self.kept = [np.empty(0, np.int64) for _ in range(4)]
        self.floor = np.full(questions, np.iinfo(np.int64).min)

    def offer(self, allowed: np.ndarray, scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, own: np.ndarray) -> None:
        """``scores`` is questions x rows, of the questions ``own``; only ``allowed`` cells count."""
        q, r = np.nonzero(allowed & (scores >= self.floor[own][:, None]))
        if not len(q):
            return
        new = (own[q], scores[q, r], ids[r], rows[r])
        question, score, id_, row = (np.concatenate(x) for x in zip(self.kept, new))
        order = np.lexsort((row, id_, ~score, question))
        place = np.arange(len(order)) - np.searchsorted(question[order], question[order])
        order, place = order[place < self.k], place[place < self.k]
        self.kept = [x[order] for x in (question, score, id_, row)]
        full = place == self.k - 1
        self.floor[self.kept[0][full]] = self.kept[1][full]


def matrix(column: pa.Array, size: int) -> np.ndarray:
    """Lists as rows of ``size`` numbers, short ones filled with zeros."""
    ends = column.offsets.to_numpy()
    lengths = np.diff(ends)
    out = np.zeros((len(column), size), np.int64)
    row = np.repeat(np.arange(len(column)), lengths)
    out[row, np.arange(len(row)) - np.repeat(ends[:-1] - ends[0], lengths)] = column.flatten().to_numpy()
    return out


def whole(table: pa.Table, name: str) -> pa.Array:
    return table.column(name).combine_chunks()


def scored(anchors: pa.Table, rows: pa.Table, size: int, bias: int, most: int) -> Iterator[tuple[slice, slice, np.ndarray]]:
    """(anchors, rows, scores) for parts of both."""
    a, r = matrix(whole(anchors, "_v"), size), matrix(whole(rows, "_v"), size)
    step = max(1, CELLS // FIELDS)
    for at in range(0, len(r), FIELDS):
        fields = Packed(r[at : at + FIELDS], bias, most)
        for first in range(0, len(a), step):
            yield slice(first, first + step), slice(at, at + FIELDS), fields.products(a[first : first + step])


def numpy_of(table: pa.Table, *names: str) -> list[np.ndarray]:
    return [table.column(n).to_numpy() for n in names]


HIT = "_anchor bigint, _slot int, _score bigint, _found bigint, _found_row bigint"


def hits(best: Best, anchors: pa.Table, slots: int) -> pa.Table:
    question, score, found, row = best.kept
    own = anchors.column("_row").to_numpy()[question // slots]
    slot = (question % slots).astype(np.int32)
    names = [part.split()[0] for part in HIT.split(", ")]
    return pa.table(dict(zip(names, map(pa.array, (own, slot, score, found, row)))))


def bounds(scores: list[list[int]], lowest: int, highest: int, slots: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest product of a negative for each positive; where there is none, no product fits."""
    low = np.full((len(scores), slots), np.iinfo(np.int64).max)
    high = np.full((len(scores), slots), np.iinfo(np.int64).min)
    for i, own in enumerate(scores):
        for j, score in enumerate(own):
            low[i, j], high[i, j] = -(-lowest * score // 100), highest * score // 100
    return low, high


def met(anchors: DataFrame, rows: DataFrame, blocks: tuple[int, int], find) -> DataFrame:
    """Every block of anchors with every block of rows."""
    n_anchors, n_rows = (F.lit(n).cast("bigint") for n in blocks)

    def block(n: Column) -> Column:
        return F.pmod(F.xxhash64("_row"), n)

    def all_of(n: Column) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))

    left = anchors.withColumn("ab", block(n_anchors)).withColumn("rb", all_of(n_rows))
    right = rows.withColumn("rb", block(n_rows)).withColumn("ab", all_of(n_anchors))
    return left.groupBy("ab", "rb").cogroup(right.groupBy("ab", "rb")).applyInArrow(find, HIT)


def first_k(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("_anchor", "_slot").orderBy(F.desc("_score"), "_found", "_found_row")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def prepared(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, anchor: Column) -> DataFrame:
    """_row, _id, _label, _v, _is_anchor of the rows that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    known = F.forall(vector_col, lambda x: finite(x.cast("double")))
    bound = F.lit(float(isqrt((1 << 63) - 1)) / 2) / F.sqrt(F.greatest(F.size(vector_col), F.lit(1)).cast("double"))
    whole = F.transform(
        vector_col,
        lambda x: F.floor(F.greatest(F.least(F.lit(SCALE) * x.cast("double"), bound), -bound)).cast("bigint"),
    )
    named = F.col(id_col).isNotNull() & F.col(label_col).isNotNull()
    return vectors.where(named & F.coalesce(known, F.lit(False))).select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).cast("bigint").alias("_id"),
        F.col(label_col).alias("_label"),
        whole.alias("_v"),
        F.coalesce(anchor, F.lit(False)).alias("_is_anchor"),
    )


def hard_negatives(
    vectors: DataFrame,
    anchor: Column,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    lowest: int = LOWEST,
    highest: int = HIGHEST,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    blocks: tuple[int, int] = (ANCHOR_BLOCK, ROW_BLOCK),
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    An anchor's positives are the ``positives`` other rows of its label with the highest products. A positive's
    negatives are the first ``negatives`` rows of another label whose product with the anchor is ``lowest`` to
    ``highest`` percent of the positive's. Ties go to the smaller id, equal ids to either row.
    """
    rows = keep(prepared(vectors, id_col, vector_col, label_col, anchor), "vectors")
    each = F.array_max("_v").alias("top"), F.array_min("_v").alias("bottom"), F.size("_v").alias("size")
    facts = rows.select("_is_anchor", *each).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("_is_anchor").alias("anchors"),
        F.max("top").alias("top"),
        F.min("bottom").alias("bottom"),
        F.max("size").alias("size"),
    ).first()
    bias = max(0, -(facts["bottom"] or 0))
    most, size = max(0, facts["top"] or 0) + bias, facts["size"] or 0
    # columns of their own, as anchors are joined to the table they come from
    anchors = rows.where("_is_anchor").select([F.col(c).alias(c) for c in ("_row", "_id", "_label", "_v")])
    rows = rows.select("_row", "_id", "_label", "_v")
    n_blocks = facts["anchors"] // blocks[0] + 1, facts["n"] // blocks[1] + 1

    def find_positives(a: pa.Table, r: pa.Table) -> pa.Table:
        best = Best(a.num_rows, positives)
        if a.num_rows and r.num_rows:
            own, own_label = numpy_of(a, "_row", "_label")
            row, label, ids = numpy_of(r, "_row", "_label", "_id")
            for left, right, scores in scored(a, r, size, bias, most):
                same = own_label[left, None] == label[None, right]
                same &= own[left, None] != row[None, right]
                best.offer(same, scores, ids[right], row[right], np.arange(a.num_rows)[left])
        release()
        return hits(best, a, 1)

    found = keep(first_k(met(anchors.drop("_id"), rows, n_blocks, find_positives), positives), "positives")
    lists = found.groupBy("_anchor").agg(F.array_sort(F.collect_list(F.struct("rank", "_score"))).alias("found"))
    asked = anchors.join(lists, F.col("_anchor") == F.col("_row")).select(
        "_row", "_label", "_v", F.col("found._score").alias("_scores")
    )

    def find_negatives(a: pa.Table, r: pa.Table) -> pa.Table:
        best = Best(a.num_rows * positives, negatives)
        if a.num_rows and r.num_rows:
            (own_label,) = numpy_of(a, "_label")
            row, label, ids = numpy_of(r, "_row", "_label", "_id")
            low, high = bounds(a.column("_scores").to_pylist(), lowest, highest, positives)
            for left, right, scores in scored(a, r, size, bias, most):
                other = own_label[left, None] != label[None, right]
                for slot in range(positives):
                    fits = other & (scores >= low[left, slot, None]) & (scores <= high[left, slot, None])
                    best.offer(fits, scores, ids[right], row[right], np.arange(a.num_rows)[left] * positives + slot)
        release()
        return hits(best, a, positives)

    chosen = first_k(met(asked, rows, n_blocks, find_negatives), negatives)
    positive = found.select(
        "_anchor", (F.col("rank") - 1).alias("_slot"), F.col("_found").alias("positive_id"), F.col("_score").alias("positive_score")
    )
    names = anchors.select(F.col("_row").alias("_anchor"), F.col("_id").alias("_anchor_id"))
    return (
        chosen.join(positive, ["_anchor", "_slot"])
        .join(names, "_anchor")
        .select(
            F.col("_anchor_id").alias("anchor_id"),
            "positive_id",
            "rank",
            F.col("_found").alias("negative_id"),
            "positive_score",
            F.col("_score").alias("negative_score"),
        )
    )
