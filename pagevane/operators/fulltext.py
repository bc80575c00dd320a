"""BM25 over stored postings (``sinks.postings``): exact, reading only blocks that can matter."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagevane.operators.nearest import SCORE_DECIMALS, top_k
from pagevane.operators.search import K1, B, query_terms
from pagevane.sinks.postings import bucket_of, read_blocks, read_sizes

# Blocks of a term whose texts give the first bound of the k-th best score.
HEAD = 4
# Room for sums in another order.
SLACK = 1e-9


def _share(tf: Column, length: Column, avg_len: float) -> Column:
    """A posting's score but for the weight of its term."""
    tf = tf.cast("double")
    return tf * (K1 + 1) / (tf + F.lit(K1) * (F.lit(1 - B) + F.lit(B) * length / avg_len))


class StoredSearch:
    """One search of the stored postings at ``path``; ``found()`` has ``query_id, key, load, score, rank``.

    Three steps: sizes and, from the blocks' own numbers, the weight of each term and the most a text can get from
    it; then the scores of the texts in each term's best blocks, whose k-th best is a bound from below; then all
    blocks that can hold a text above the bound, given the most that it can get from the other terms. A text
    above the bound has all its postings in such blocks, so its score is whole. Only numbers for each term and
    query of the search reach the driver.
    """

    def __init__(
        self, spark: SparkSession, path: str, queries: dict[str, str], k: int = 10, key: T.DataType = T.StringType()
    ):
        self.spark, self.k = spark, k
        self.terms = {q: list(dict.fromkeys(query_terms(words))) for q, words in queries.items()}
        sums = read_sizes(spark, path).agg(
            F.sum("texts"), F.sum("measured"), F.sum("words"), F.sort_array(F.collect_set("buckets"))
        )
        texts, measured, words, self.buckets = sums.first()
        self.texts, self.avg_len = texts or 0, (words or 0) / (measured or 1) or 1.0
        self.blocks = self._blocks_of(read_blocks(spark, path, key))
        self.idf, self.most, self.cut = self._weights()
        self.floor = self._floors()

    def _blocks_of(self, blocks: DataFrame) -> DataFrame:
        """Blocks of the search's terms, by folder and by term, and the most that a posting in each can have."""
        wanted = sorted({t for found in self.terms.values() for t in found})
        rows = self.spark.createDataFrame([(t,) for t in wanted], "term string")
        # Loads may have been cut into different numbers of folders.
        folders = F.explode(F.array(*(bucket_of(F.col("term"), n) for n in self.buckets)))
        buckets = sorted({r["b"] for r in rows.select(folders.alias("b")).collect()})
        chosen = blocks.filter(F.col("bucket").isin(*buckets) & F.col("term").isin(*wanted))
        return chosen.withColumn("share", _share(F.col("max_tf"), F.col("min_length"), self.avg_len))

    def _weights(self) -> tuple[dict, dict, dict]:
        light = self.blocks.select("term", "n", "share")
        best = light.selectExpr("term", "share", "row_number() over (partition by term order by share desc) as place")
        cuts = best.filter(F.col("place") <= HEAD).groupBy("term").agg(F.min("share").alias("cut"))
        counted = light.groupBy("term").agg(F.sum("n").alias("texts"), F.max("share").alias("most"))
        rows = counted.join(cuts, "term").collect()
        idf = {r["term"]: math.log(1.0 + (self.texts - r["texts"] + 0.5) / (r["texts"] + 0.5)) for r in rows}
        return idf, {r["term"]: r["most"] for r in rows}, {r["term"]: r["cut"] for r in rows}

    def _scored(self, least: dict[tuple[str, str], float]) -> DataFrame:
        """Scores of texts over the blocks whose ``share`` is at least that of (query, term)."""
        rows = [(q, t, self.idf[t], share) for (q, t), share in least.items()]
        asked = self.spark.createDataFrame(rows, "query_id string, term string, idf double, least double")
        # As many rows as the search has terms.
        met = self.blocks.join(F.broadcast(asked), "term").filter("share >= least")
        one = met.select("query_id", "term", "idf", "load", F.inline("entries"))
        score = F.col("idf") * _share(F.col("tf"), F.col("length"), self.avg_len)
        whole = one.groupBy("query_id", "load", "doc", "key").agg(F.round(F.sum(score), SCORE_DECIMALS).alias("score"))
        return whole.filter("score > 0")

    def _pairs(self) -> list[tuple[str, str]]:
        return [(q, t) for q, found in self.terms.items() for t in found if t in self.idf]

    def _floors(self) -> dict[str, float]:
        """For each query a score that at least k texts reach, if its best blocks have so many."""
        heads = {(q, t): self.cut[t] for q, t in self._pairs()}
        best = top_k(self._scored(heads), "query_id", "doc", self.k)
        rows = best.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("least")).collect()
        return {r["query_id"]: r["least"] for r in rows if r["n"] == self.k}

    def least_shares(self) -> dict[tuple[str, str], float]:
        """What a block must offer to be read, for each query and term."""
        out = {}
        for q, t in self._pairs():
            others = sum(self.idf[o] * self.most[o] for o in self.terms[q] if o != t and o in self.idf)
            out[q, t] = (self.floor.get(q, 0.0) - others - SLACK) / self.idf[t] if self.idf[t] > 0 else 0.0
        return out

    def found(self) -> DataFrame:
        return top_k(self._scored(self.least_shares()), "query_id", "key", self.k, "load", "doc").drop("doc")


def search_postings(
    spark: SparkSession, path: str, queries: dict[str, str], k: int = 10, key: T.DataType = T.StringType()
) -> DataFrame:
    """The k best texts for each query string over all loads: ``query_id, load, key, score, rank``."""
    return StoredSearch(spark, path, queries, k, key).found()
