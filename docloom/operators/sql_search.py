"""Search as SQL functions over stored postings."""

from __future__ import annotations

from pyspark.sql import DataFrame

from docloom.operators.postings import Stored

WORDS = r"split(lower({question}), '[^\\p{{L}}0-9]+')"
# A partition filter on the folders, then a filter on the terms in them.
WANTED = f"""array_contains(transform({WORDS}, t -> pmod(xxhash64(t), {{folders}})), folder)
    AND array_contains({WORDS}, term)"""
# The question's terms are a handful of rows, hence the broadcast and the
# unpartitioned window over them. A chunk's postings lie in blocks of one shard, which number the chunks, and so do
# the ids of these numbers: its score needs no shuffle. The window over chunk scores is cut to the wanted ranks in every
# task before the rest meets in one.
RANKED = f"""
  SELECT chunk_id, score, CAST(row_number() OVER (ORDER BY score DESC, chunk_id) AS BIGINT) AS rank
  FROM (
    SELECT chunk_id, round(sum(score), 6) AS score
    FROM (
      SELECT h.shard, element_at(n.ids, h.doc + 1) AS chunk_id, h.score
      FROM (
        SELECT p.shard, p.doc, sum(p.weight * q.w) AS score
        FROM (
          SELECT shard, term, doc, weights[place] AS weight
          FROM (SELECT shard, term, docs, weights FROM search_blocks WHERE array_contains({WORDS}, term))
          LATERAL VIEW posexplode(docs) AS place, doc
        ) p
        JOIN (
          SELECT /*+ BROADCAST */ term, w / sqrt(sum(w * w) OVER ()) AS w
          FROM (
            SELECT t.term, t.tf * ln(1 + {{n}} / d.df) AS w
            FROM (SELECT term, count(*) AS tf FROM (SELECT explode({WORDS}) AS term) GROUP BY term) t
            JOIN (SELECT term, df FROM search_terms WHERE {WANTED}) d ON d.term = t.term
          )
        ) q ON q.term = p.term
        GROUP BY p.shard, p.doc
      ) h
      JOIN (SELECT shard, ids FROM search_blocks WHERE term IS NULL) n ON n.shard = h.shard
    )
    GROUP BY shard, chunk_id
  )"""


def register(index: DataFrame, stored: Stored) -> None:
    """Create the temporary functions ``search_chunks`` and ``vector_search``.

    ``search_chunks(question)`` gives the five best chunk texts as one string,
    ``vector_search(query, num_results)`` gives ranked rows. Both rank as
    ``postings.search`` does. Arguments are literals: only then are the folders cut
    down while planning and the broadcast terms few. A question reads the stored blocks once, in place; nothing more is
    written for it. Use ``postings.search`` for a column of questions.
    """
    spark = index.sparkSession
    index.createOrReplaceTempView("search_index")
    stored.blocks.createOrReplaceTempView("search_blocks")
    stored.terms.createOrReplaceTempView("search_terms")

    def ranked(argument: str) -> str:
        return RANKED.format(question=argument, folders=stored.folders, n=stored.n)

    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION search_chunks(question STRING COMMENT 'what to look for')
        RETURNS STRING
        COMMENT 'Texts of the five chunks nearest to the question'
        RETURN SELECT string(array_sort(collect_set(i.chunked_text)))
               FROM search_index i
               JOIN (SELECT /*+ BROADCAST */ * FROM ({ranked("question")}) WHERE rank <= 5) h
                 ON h.chunk_id = i.chunk_id""")
    spark.sql(f"""
        CREATE OR REPLACE TEMPORARY FUNCTION vector_search(query STRING, num_results INT)
        RETURNS TABLE (rank BIGINT, score DOUBLE, chunk_id STRING, path STRING, chunked_text STRING)
        RETURN SELECT h.rank, h.score, h.chunk_id, i.path, i.chunked_text
               FROM search_index i
               JOIN (SELECT /*+ BROADCAST */ * FROM ({ranked("query")}) WHERE rank <= num_results) h
                 ON h.chunk_id = i.chunk_id""")
