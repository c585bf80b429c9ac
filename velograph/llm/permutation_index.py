"""Approximate nearest neighbours by a permutation index.

A vector is represented by the order of its nearest pivots, and posted in the inverted files of its first POSTS pivots. A query
reads the files of its own first PROBES pivots. Of the rows that a file brings (a row that several of them hold counts in that of
its first pivot among them), it ranks by footrule distance between the orders of the first RANKED pivots, and reranks the best
CANDIDATES by the exact cosine in double precision. The k-th best of these is a floor: every other row that the file brings
and whose cosine may reach it, by a product of unit vectors and a bound on its rounding, is scored, too. So dense clusters,
whose permutations hardly differ, lose nothing that their files hold, and the answer doesn't depend on the order of rows.

Equal vectors are one node with its least vec_ids, as many as a search may return, so copies cost no more than one row. Pivots are
a bounded sample (the nodes of the smallest hashes), dense where rows are; their number grows with the root of the
number of rows, between PIVOTS_LEAST and PIVOTS_MOST, so a query reads a falling share of the rows: all of them up to some
thousands, half of 50,000, a third from 250,000 on. Every row is indexed. Files are dealt out in blocks of BLOCK rows and
BLOCK queries, so tasks are bounded whatever the clusters are. What is lost are neighbours in files that aren't read; recall
against brute force is measured in the tests and the README.

Vectors that are null, zero, or hold null or non-finite components take no part, nor do those without a vec_id or with
another length than the most common one. A query's own vec_id is no candidate of it. Ties go to the smaller vec_id; repeated
rows with one vec_id and one vector count once; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from velograph.llm.shared import settle

PIVOTS_LEAST, PIVOTS_MOST, RANKED = 64, 1024, 256
POSTS, PROBES, CANDIDATES, BLOCK = 4, 96, 16, 1024
POSTED = "h1 long, v array<double>, ids array<long>, places binary, posts array<short>"
ASKED = "query_id long, v array<double>, places binary, probes array<short>"
FOUND = "query_id long, score double, ids array<long>"
ANSWER = "query_id long, rank int, vec_id long, score double"
NAME = ["h1", "h2"]


def valid_vectors(df: DataFrame, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, v array<double>) of the rows that take part."""
    v = F.transform(F.col(vector), lambda x: x.cast("double"))
    df = df.select(F.col(vec_id).cast("long").alias("vec_id"), v.alias("v")).filter("vec_id IS NOT NULL AND v IS NOT NULL")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.filter(~F.coalesce(bad, F.lit(True)) & F.exists("v", lambda x: x != 0))


def number_of_pivots(rows: int) -> int:
    """The power of two from twice the root of the number of rows on."""
    return min(PIVOTS_MOST, max(PIVOTS_LEAST, 1 << int(np.ceil(np.log2(2 * np.sqrt(max(rows, 1)))))))


def nearest_pivots(vectors: np.ndarray, pivots: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row the place of each of the first RANKED pivots in their order of nearness, as bytes, and the n nearest of all pivots
    in order; ties to the smaller pivot."""
    far = -(vectors / np.linalg.norm(vectors, axis=1, keepdims=True)) @ pivots.T
    order = np.argsort(far[:, :RANKED], axis=1, kind="stable")
    places = np.empty(order.shape, np.uint8)
    np.put_along_axis(places, order, np.arange(order.shape[1], dtype=np.uint8)[None], axis=1)
    return places, np.argsort(far, axis=1, kind="stable")[:, :n].astype(np.int16)


def sums(x: np.ndarray) -> np.ndarray:
    """Of each row the sum, in order of the components."""
    return np.add.accumulate(x, axis=1)[:, -1]


def cosine(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Exact cosines of a query, or of one query a row, with rows."""
    query = np.atleast_2d(query)
    return sums(rows * query) / (np.sqrt(sums(query * query)) * np.sqrt(sums(rows * rows)))


def matrix(column: pa.ChunkedArray | pa.Array, kind=np.float64) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.asarray(flat.flatten(), kind).reshape(len(column), -1)


def byte_rows(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def rounding(dim: int) -> float:
    """A bound on how far a product of unit vectors may lie from cosine(): both sum dim terms, in any order."""
    return 8 * (dim + 8) * np.finfo(np.float64).eps


def footrules(places: np.ndarray, own: np.ndarray) -> np.ndarray:
    """places: [row, pivot]; own: the query's place of each pivot."""
    return (np.maximum(places, own) - np.minimum(places, own)).sum(axis=1, dtype=np.uint32)


def search_file(file: int, posted: pa.Table, asking: pa.Table, pivots: int, k: int) -> pa.Table:
    """FOUND of the rows of a block of a file, for queries that read it: k nodes of each query at most."""
    names = ["query_id", "score", "ids"]
    none = pa.table([pa.array([], pa.int64()), pa.array([], pa.float64()), pa.array([], pa.list_(pa.int64()))], names=names)
    if not posted.num_rows or not asking.num_rows:
        return none
    rows, places, posts = matrix(posted["v"]), byte_rows(posted["places"]), matrix(posted["posts"], np.int64)
    asked, own, probes = matrix(asking["v"]), byte_rows(asking["places"]), matrix(asking["probes"], np.int64)
    ids, qids = posted["ids"].combine_chunks(), np.asarray(asking["query_id"])
    first, n = np.asarray(ids.flatten())[np.asarray(ids.offsets)[:-1] - ids.offsets[0].as_py()], len(rows)
    alone = np.diff(np.asarray(ids.offsets)) == 1
    second = np.asarray(ids.flatten())[np.minimum(np.asarray(ids.offsets)[:-1] - ids.offsets[0].as_py() + 1, len(ids.flatten()) - 1)]
    unit, asked_unit = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (rows, asked))
    pairs: list[tuple[np.ndarray, np.ndarray]] = []
    for i in range(len(asked)):
        reads = np.zeros(pivots, bool)
        reads[probes[i]] = True
        hit = reads[posts]
        mine = (posts[np.arange(n), hit.argmax(axis=1)] == file) & ~(alone & (first == qids[i]))
        at = np.flatnonzero(mine)
        if len(at) > CANDIDATES:
            distance = footrules(places[at], own[i])
            best = at[np.argpartition(distance, CANDIDATES)[:CANDIDATES]]
            floor = np.partition(cosine(asked[i], rows[best]), -min(k, CANDIDATES))[-min(k, CANDIDATES)]
            # not below, instead of above, so that what isn't a number stays open
            at = at[~(unit[at] @ asked_unit[i] + rounding(rows.shape[1]) < floor)]
        if len(at):
            pairs.append((np.full(len(at), i), at))
    if not pairs:
        return none
    q, r = (np.concatenate(x) for x in zip(*pairs, strict=True))
    score = cosine(asked[q], rows[r])
    least = np.where(first[r] == qids[q], second[r], first[r])
    order = np.lexsort((least, -score, q))
    q, r, score = q[order], r[order], score[order]
    starts = np.flatnonzero(np.concatenate(([True], q[1:] != q[:-1])))
    keep = np.arange(len(q)) - np.repeat(starts, np.diff(np.append(starts, len(q)))) < k
    return pa.table([pa.array(qids[q[keep]], pa.int64()), pa.array(score[keep], pa.float64()), ids.take(pa.array(r[keep]))], names=names)


class PermutationIndex:
    """Pivots and the posted rows of a table; search() may be called with any queries, for up to most neighbours of each."""

    def __init__(self, vectors: DataFrame, most: int = 5):
        self.spark, self.most = vectors.sparkSession, most
        rows = settle(valid_vectors(vectors).select("vec_id", "v", F.xxhash64("v").alias("h1"), F.xxhash64(F.lit(1), "v").alias("h2")), "vectors")
        sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").limit(1).collect()
        self.n = sizes[0]["count"] if sizes else 0
        if not self.n:
            return
        self.rows = rows.filter(F.size("v") == sizes[0]["d"])
        # the least ids of equal vectors; one more than may be asked for, as a query leaves out its own
        least = W.partitionBy(*NAME).orderBy("vec_id")
        named = self.rows.select("vec_id", *NAME).distinct().withColumn("r", F.row_number().over(least)).filter(F.col("r") <= most + 1)
        named = named.groupBy(*NAME).agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        nodes = self.rows.groupBy(*NAME).agg(F.first("v").alias("v")).join(named, NAME).select("h1", "h2", "v", "ids")
        nodes = settle(nodes, "nodes")
        self.pivots = number_of_pivots(nodes.count())
        sample = np.array([r[0] for r in nodes.orderBy(*NAME).limit(self.pivots).select("v").collect()])
        self.pivots = len(sample)
        self.held = held = self.spark.sparkContext.broadcast(sample / np.linalg.norm(sample, axis=1, keepdims=True))

        def run(batches):
            for b in batches:
                if b.num_rows:
                    places, posts = nearest_pivots(matrix(b.column(1)), held.value, POSTS)
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x.tobytes() for x in places], pa.binary()), pa.array(list(posts), pa.list_(pa.int16()))], names=["h1", "v", "ids", "places", "posts"])

        self.posted = settle(nodes.select("h1", "v", "ids").mapInArrow(run, POSTED), "posted")

    def asked(self, which: Column) -> DataFrame:
        """ASKED of the rows with which. Written out."""
        held = self.held

        def run(batches):
            for b in batches:
                if b.num_rows:
                    places, probes = nearest_pivots(matrix(b.column(1)), held.value, PROBES)
                    yield pa.RecordBatch.from_arrays([*b.columns, pa.array([x.tobytes() for x in places], pa.binary()), pa.array(list(probes), pa.list_(pa.int16()))], names=["query_id", "v", "places", "probes"])

        one = self.rows.filter(which).groupBy("vec_id").agg(F.min_by("v", F.struct(*NAME)).alias("v"))
        return settle(one.select(F.col("vec_id").alias("query_id"), "v").mapInArrow(run, ASKED), "asked")

    def search(self, which: Column, k: int = 5) -> DataFrame:
        """query_id, rank (from 1), vec_id, score: of each row of the table with which, its k nearest found."""
        if k > self.most:
            raise ValueError(f"the index was built for {self.most} neighbours at most")
        if not self.n:
            return self.spark.createDataFrame([], ANSWER)
        asked = self.asked(which)
        left, right = self.posted.withColumn("file", F.explode("posts")), asked.withColumn("file", F.explode("probes"))

        def blocks(rows: DataFrame) -> Column:
            """Of a file, its number of blocks: PIVOTS_MOST counts at most come to the driver."""
            counts = {r["file"]: -(-r["count"] // BLOCK) for r in rows.groupBy("file").count().collect()}
            return F.get(F.array(*[F.lit(counts.get(f, 0)) for f in range(self.pivots)]), F.col("file").cast("int"))

        n_rows, n_asked = blocks(left), blocks(right)
        own = lambda key, n: F.pmod(F.xxhash64(key, "file"), n).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), n - 1))
        left = left.filter(n_asked > 0).withColumn("br", own("h1", n_rows)).withColumn("bq", every(n_asked))
        right = right.filter(n_rows > 0).withColumn("bq", own("query_id", n_asked)).withColumn("br", every(n_rows))
        pivots = self.pivots
        key = ("file", "br", "bq")
        found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(lambda at, posted, asking: search_file(at[0].as_py(), posted, asking, pivots, k), FOUND)
        best = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        each = found.select("query_id", F.explode("ids").alias("vec_id"), "score").filter("vec_id <> query_id")
        # dense, as a vec_id that has two equally near vectors counts once
        return each.withColumn("rank", F.dense_rank().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score").distinct()
