"""Context around hits: the hit, its neighbours in its entry, and the first chunks of related entries, as far as a budget of tokens reaches."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from corpusmill.operators.rank import ranked
from corpusmill.session import stored


def fan_out(hits: DataFrame, chunks: DataFrame, siblings: DataFrame, *, budget: int, near: int = 4, related: int = 3, each: int = 2) -> DataFrame:
    """query_id, place (from 1), chunk_id, hop and total (tokens so far) of the chunks taken for each hit.

    ``hits``: query_id and chunk_id; ``chunks``: chunk_id, document_slug, idx and tokens; ``siblings``: a, b and score of related entries.
    In this order: the hit (hop 0); up to ``near`` chunks before and after it in its entry, the nearest first, of two equally near the earlier
    (hop 1); the first ``each`` chunks of its ``related`` most similar entries, ties by name (hop 2). A chunk that no longer fits into the
    budget is passed over, and later, smaller ones may still be taken.

    What stands around a hit is looked up by entry and place, so an entry of any length costs the few rows that are wanted; a query's state is
    its list of at most 1 + 2 * near + related * each chunks. Hits of chunks that aren't there give nothing."""
    placed = stored(ranked(chunks.where("document_slug IS NOT NULL").select("chunk_id", "document_slug", "idx", "tokens"), ["document_slug"], "idx"))
    own = stored(hits.select("query_id", "chunk_id").join(placed.select("chunk_id", "document_slug", "rank"), "chunk_id").select("query_id", "document_slug", F.col("rank").alias("at")))
    offer = lambda hop, first, second: F.struct(F.lit(hop).alias("hop"), first.cast("long").alias("first"), second.cast("long").alias("second"), "chunk_id", "tokens").alias("offer")

    around = own.select("query_id", "document_slug", "at", F.explode(F.sequence(F.col("at") - near, F.col("at") + near)).alias("rank"))
    around = around.join(placed, ["document_slug", "rank"])
    far = F.abs(F.col("rank") - F.col("at"))
    around = around.select("query_id", F.when(far == 0, offer(0, far, F.col("rank"))).otherwise(offer(1, far, F.col("rank"))).alias("offer"))

    best = Window.partitionBy("a").orderBy(F.desc("score"), "b")
    nearest = siblings.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= related).select("a", "b", "nth")
    heads = placed.where(F.col("rank") <= each)
    lists = nearest.join(heads, nearest["b"] == heads["document_slug"]).select("a", offer(2, F.col("nth"), F.col("rank")))
    lists = lists.groupBy("a").agg(F.collect_list("offer").alias("offers"))  # related * each at most
    beyond = own.join(lists, own["document_slug"] == lists["a"]).select("query_id", F.explode("offers").alias("offer"))

    offers = around.unionByName(beyond).groupBy("query_id").agg(F.array_sort(F.collect_list("offer")).alias("offers"))
    taken = "array<struct<chunk_id:string,hop:int,total:bigint>>"
    start = F.struct(F.lit(0).cast("long").alias("total"), F.array().cast(taken).alias("taken"))

    def take(state, o):
        total = state["total"] + F.coalesce(o["tokens"], F.lit(0)).cast("long")
        more = F.concat(state["taken"], F.array(F.struct(o["chunk_id"].alias("chunk_id"), o["hop"].alias("hop"), total.alias("total"))))
        return F.when(total <= budget, F.struct(total.alias("total"), more.alias("taken"))).otherwise(state)

    rows = offers.select("query_id", F.posexplode(F.aggregate("offers", start, take, lambda s: s["taken"])).alias("place", "t"))
    return rows.select("query_id", (F.col("place") + 1).alias("place"), "t.chunk_id", "t.hop", "t.total")
