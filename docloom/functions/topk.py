"""Running top-k over score blocks, used inside Arrow tasks.

A task keeps at most k hits per query (plus nothing else), so the number of
rows it emits does not depend on how many rows it scored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

CELLS = 4_000_000
#: Queries scored together; more are taken block by block, so that a slice of rows stays long.
QUERIES = 2_000
#: Scores are compared rounded to six decimals; cells this far below a floor cannot reach it.
MARGIN = 1e-6


class TopK:
    """Best k (score, id) per query; ties on the rounded score go to the smaller id.

    Hits lie in queries x k arrays. Per query the k-th score so far is a floor: of a slice
    only the cells at the floor or above are looked at again, so a slice costs one comparison per
    cell and a sort of the queries that gained a hit.
    """

    def __init__(self, n_queries: int, k: int):
        self.k = k
        self.floor = np.full(n_queries, -np.inf)
        self.score = np.full((n_queries, k), -np.inf)
        self.ids: np.ndarray | None = None

    def offer(self, scores: np.ndarray, ids: np.ndarray, first: int = 0) -> None:
        """``scores`` is queries x rows, for the queries from ``first`` on."""
        self.offer_to(np.arange(first, first + len(scores)), scores, ids)

    def offer_to(self, own: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """``scores`` is queries x rows, for the different queries ``own``."""
        if not scores.size:
            return
        floor = self.floor[own]
        new = np.flatnonzero(np.isneginf(floor))
        if scores.shape[1] > self.k and len(new):
            floor[new] = np.partition(scores[new], -self.k, axis=1)[:, -self.k]
        q, r = np.nonzero(scores >= (floor - MARGIN)[:, None])
        self.offer_cells(own[q], scores[q, r], ids[r])

    def offer_cells(self, query: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        """A score and an id for each of ``query``, which may repeat."""
        if not len(query):
            return
        if self.ids is None:
            self.ids = np.empty(self.score.shape, dtype=ids.dtype)
        elif ids.dtype.itemsize > self.ids.dtype.itemsize:
            self.ids = self.ids.astype(ids.dtype)
        to = np.unique(query)
        old_score, old_id = self.score[to], self.ids[to]
        held = old_score > -np.inf
        query = np.concatenate([np.nonzero(held)[0], np.searchsorted(to, query)])
        score = np.concatenate([old_score[held], np.round(scores, 6).astype(np.float64)])
        found = np.concatenate([old_id[held], ids])
        order = np.lexsort((found, -score, query))
        query, score, found = query[order], score[order], found[order]
        place = np.arange(len(query)) - np.searchsorted(query, query, side="left")
        keep = place < self.k
        row, column = to[query[keep]], place[keep]
        self.score[to] = -np.inf
        self.score[row, column], self.ids[row, column] = score[keep], found[keep]
        self.floor[to] = np.maximum(self.floor[to], self.score[to, self.k - 1])

    def batch(self, names: np.ndarray, name_type: pa.DataType, id_type: pa.DataType) -> pa.RecordBatch:
        """The hits kept so far as (query_id, id, score)."""
        query, place = np.nonzero(self.score > -np.inf)
        found = self.ids[query, place].tolist() if self.ids is not None else []
        return pa.RecordBatch.from_arrays(
            [
                pa.array(names[query].tolist(), type=name_type),
                pa.array(found, type=id_type),
                pa.array(self.score[query, place]),
            ],
            names=["query_id", "id", "score"],
        )
