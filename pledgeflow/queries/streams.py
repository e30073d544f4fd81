"""Streaming jobs drained over files derived from the tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from pledgeflow.operators.buckets import BucketTable
from pledgeflow.queries.registry import query
from pledgeflow.schemas import layout
from pledgeflow.session import work_path
from pledgeflow.streaming import landing

_TABLE = "id bigint, state string, pledged double"


@query(
    "stream_upsert",
    """select o_orderkey as id, 'old' as state, 0.0::double as pledged from orders
        where o_orderpriority = '1-URGENT' and o_orderstatus = 'P'
    union all select o_orderkey, o_orderstatus, o_totalprice + 3 from orders where o_orderstatus <> 'P'""",
)
def stream_upsert(t):
    folder = work_path(t.spark, "stream")
    docs = t.orders.filter("o_orderstatus <> 'P'").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderstatus").alias("state"),
        F.explode(F.sequence(F.lit(1), F.lit(3))).alias("seq"),
        "o_totalprice",
    )
    documents = docs.select("id", "state", (F.col("o_totalprice") + F.col("seq")).alias("pledged"), "seq")
    documents.repartition(4, "id").write.json(f"{folder}/landing")
    table = layout(_TABLE)
    stream = landing.json_stream(t.spark, f"{folder}/landing", _TABLE + ", seq int, extra string", 2)
    landing.land_deltas(
        stream, table, ["id"], [F.desc("seq")], f"{folder}/deltas", f"{folder}/checkpoint"
    ).awaitTermination()
    base = t.orders.filter("o_orderpriority = '1-URGENT'").select(
        F.col("o_orderkey").alias("id"), F.lit("old").alias("state"), F.lit(0.0).alias("pledged")
    )
    stored = BucketTable(f"{folder}/base", table, ["id"], 16)
    stored.write(base)
    # the first batch is folded into the base, the others are merged on read
    deltas = landing.read_deltas(t.spark, f"{folder}/deltas", table)
    last = landing.compacted(stored, deltas.filter("batch = 0"))
    return landing.merged(stored.read(t.spark), landing.read_deltas(t.spark, f"{folder}/deltas", table, last), ["id"])


@query(
    "stream_snapshot",
    "select user_id as projectid, ts as modified, event_type as status from events",
)
def stream_snapshot(t):
    folder = work_path(t.spark, "states")
    states = t.events.select(
        F.col("user_id").alias("projectid"), F.col("ts").cast("timestamp").alias("modified"), F.col("event_type").alias("status")
    )
    # every state is delivered twice, the newest first and the oldest last
    parts = states.union(states).repartitionByRange(4, F.desc("modified"))
    parts.write.option("timestampFormat", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").json(f"{folder}/landing")
    stream = landing.json_stream(t.spark, f"{folder}/landing", "projectid bigint, modified timestamp, status string", 1)
    landing.append_new_states(
        stream, ["projectid", "modified"], ["status"], f"{folder}/out", f"{folder}/checkpoint"
    ).awaitTermination()
    stored = landing.read_deltas(t.spark, f"{folder}/out", layout("projectid bigint, modified timestamp, status string"))
    return stored.select("projectid", F.col("modified").cast("timestamp_ntz").alias("modified"), "status")
