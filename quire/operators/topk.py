"""Best k rows per query, and joins that send small tables.

Vectors are scored in tasks, and only the k best rows per query and task leave them.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

# Scores are compared at this many decimals (column "place"), so that the order
# in which equal terms are added up cannot decide a rank; equals rank by id.
DECIMALS = 9


def score_schema(query_type: T.DataType, id_col: str, id_type: T.DataType, query_col: str) -> T.StructType:
    return T.StructType(
        [
            T.StructField(query_col, query_type),
            T.StructField(id_col, id_type),
            T.StructField("score", T.DoubleType()),
            T.StructField("place", T.DoubleType()),
        ]
    )


class TaskTopK:
    """Running best k per query over the batches of one task."""

    def __init__(self, k: int, n_queries: int):
        self.k = k
        self.floor = np.full(n_queries, -np.inf)
        self.kept: list[pa.Table] = []
        self.rows = 0
        self.limit = max(100_000, 4 * k * n_queries)

    def offer_block(
        self, queries: np.ndarray, first_row: int, scores: np.ndarray, valid: np.ndarray | None, ids: pa.Array
    ) -> None:
        """Offer a dense (queries x rows) block of scores; ``queries`` has the numbers of its queries."""
        place = np.round(scores, DECIMALS) + 0.0
        if valid is not None:
            place = np.where(valid, place, -np.inf)
        floor = self.floor[queries]
        if place.shape[1] > self.k:
            floor = np.maximum(np.partition(place, -self.k, axis=1)[:, -self.k], floor)
        query, row = np.nonzero((place >= floor[:, None]) & (place > -np.inf))
        if len(query) == 0:
            return
        self.kept.append(
            pa.table(
                {
                    "q": queries[query],
                    "id": ids.take(pa.array(row + first_row)),
                    "score": scores[query, row],
                    "place": place[query, row],
                }
            )
        )
        self.rows += len(query)
        if self.rows > self.limit:
            self._prune()

    def _prune(self) -> pa.Table:
        table = pa.concat_tables(self.kept).combine_chunks()
        table = table.sort_by([("q", "ascending"), ("place", "descending"), ("id", "ascending")])
        query = table["q"].to_numpy()
        first = np.flatnonzero(np.r_[True, query[1:] != query[:-1]]) if len(query) else np.array([], int)
        length = np.diff(np.r_[first, len(query)])
        nth = np.arange(len(query)) - np.repeat(first, length)
        kth = np.flatnonzero(nth == self.k - 1)
        self.floor[query[kth]] = table["place"].to_numpy()[kth]
        table = table.filter(pa.array(nth < self.k))
        self.kept, self.rows = [table], table.num_rows
        self.limit = max(self.limit, 2 * table.num_rows)
        return table

    def result(self, query_ids: pa.Array, schema: pa.Schema) -> list[pa.RecordBatch]:
        if not self.kept:
            return []
        table = self._prune()
        out = pa.table(
            [query_ids.take(table["q"].combine_chunks()), table["id"], table["score"], table["place"]], names=schema.names
        )
        return out.cast(schema).to_batches()


# Tables are sent to all tasks up to so many rows; the rows are narrow (ids, numbers, words).
MAX_SENT = 500_000


def sent(stored: DataFrame, most: int = MAX_SENT) -> DataFrame:
    """Tell Spark to send a stored table to all tasks if it has ``most`` rows or fewer; beyond that Spark chooses the join."""
    return F.broadcast(stored) if stored.count() <= most else stored


def among(rows: DataFrame, keys: DataFrame, column: str) -> DataFrame:
    """The rows whose ``column`` occurs in ``keys``, a stored table."""
    right = keys.select(column).distinct()
    return rows.join(F.broadcast(right) if right.count() <= MAX_SENT else right, column, "left_semi")


# Rows of a task that groups and ranks.
ROWS_PER_TASK = 500_000


def dealt(rows: DataFrame, column: str) -> DataFrame:
    """Rows dealt by ``column``, in as many tasks as their number needs: grouping and ranking by it then need no further shuffle."""
    tasks = max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows.count() // ROWS_PER_TASK))
    return rows.repartition(tasks, column)


def rank_per_query(df: DataFrame, k: int, order: list[Column], query_id: str = "query_id") -> DataFrame:
    """Number rows 1.. per query and keep the first k."""
    window = Window.partitionBy(query_id).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= k)
