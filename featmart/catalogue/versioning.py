"""Versions, references, tags, run lineage."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..operators.diff import bag_diff, version_diff
from ..operators.digest_tree import store_version, stored_diff
from ..plans import lineage, versions
from ..workdir import new_path
from .base import V1_SQL, V2_SQL, Query, table, version_1, version_2

def diff_rows(spark, sf_dir):
    return version_diff(version_1(spark, sf_dir), version_2(spark, sf_dir), ["o_orderkey"])


_DIFF_SQL = f"""
select coalesce(a.o_orderkey, b.o_orderkey) as o_orderkey,
       case when a.o_orderkey is null then 'added' when b.o_orderkey is null then 'removed' else 'changed' end as change
from ({V1_SQL}) a full join ({V2_SQL}) b on a.o_orderkey = b.o_orderkey
where a.o_orderkey is null or b.o_orderkey is null or a.o_totalprice <> b.o_totalprice"""


def diff_types(spark, sf_dir):
    """Order keys beyond 2^53 as whole numbers and as doubles, which every second key is not."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", (F.col("o_orderkey") + F.lit(2**53)).alias("number"))
    return version_diff(orders, orders.withColumn("number", F.col("number").cast("double")), ["o_orderkey"])


def diff_stored(spark, sf_dir):
    """The same two versions, stored with their digest trees: only buckets that differ are read."""
    old, new = new_path(spark, "old-version"), new_path(spark, "new-version")
    store_version(version_1(spark, sf_dir), old, ["o_orderkey"], buckets=64)
    store_version(version_2(spark, sf_dir), new, ["o_orderkey"], buckets=64)
    return stored_diff(spark, old, new, ["o_orderkey"], buckets=64)


def diff_bags(spark, sf_dir):
    """Line items of two orders versions, without a key, by all their columns."""
    lines = table(spark, sf_dir, "lineitem")
    return bag_diff(lines.filter(F.col("l_returnflag") != "A"), lines.filter(F.col("l_returnflag") != "N"))


# A ledger in which every order is a commit on the branch of its priority.


def _commits(spark, sf_dir):
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderpriority").alias("branch"),
        F.col("o_orderkey").alias("version"),
        F.col("o_orderdate").alias("committed_at"),
        F.md5(F.col("o_orderkey").cast("string")).alias("commit_id"),
        F.col("o_orderstatus").alias("operation"),
    )


_COMMITS_SQL = """
select o_orderpriority as branch, o_orderkey as version, o_orderdate as committed_at, md5(cast(o_orderkey as varchar)) as commit_id,
       o_orderstatus as operation from orders"""


def snapshot_latest(spark, sf_dir):
    return versions.latest_snapshot(_commits(spark, sf_dir), ["branch"])


_LATEST_SQL = f"select * from ({_COMMITS_SQL}) qualify row_number() over (partition by branch order by committed_at desc, version desc) = 1"


def _tags(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        F.col("c_name").alias("tag"), F.md5(F.col("c_custkey").cast("string")).alias("commit_id")
    )


def ref_resolve(spark, sf_dir):
    """Branch names, tags, commit ids and, the suppliers, names that are none of these."""
    refs = (
        table(spark, sf_dir, "orders").select(F.col("o_orderpriority").alias("ref")).distinct()
        .union(table(spark, sf_dir, "customer").select("c_name"))
        .union(table(spark, sf_dir, "part").select(F.md5(F.col("p_partkey").cast("string"))))
        .union(table(spark, sf_dir, "supplier").select("s_name"))
    )
    return versions.resolve_refs(refs, _commits(spark, sf_dir), _tags(spark, sf_dir))


_RESOLVE_SQL = f"""
with c as ({_COMMITS_SQL}), heads as ({_LATEST_SQL})
select branch as ref, commit_id from heads union all
select c_name, md5(cast(c_custkey as varchar)) from customer union all
select md5(cast(p_partkey as varchar)), coalesce(c.commit_id, 'unknown') from part left join c on c.commit_id = md5(cast(p_partkey as varchar)) union all
select s_name, 'unknown' from supplier"""


def as_of_read(spark, sf_dir):
    """Two versions are committed; the first is read as of a time between them."""
    log = versions.VersionLog(spark, new_path(spark, "versions"))
    first, second = datetime(2024, 1, 1), datetime(2024, 1, 2)
    log.commit_table("main", "orders", version_1(spark, sf_dir), ["o_orderkey"], "first", first, "run-1")
    log.commit_table("main", "orders", version_2(spark, sf_dir), ["o_orderkey"], "second", second, "run-2")
    return log.read_at("orders", datetime(2024, 1, 1, 12))


def commit_log(spark, sf_dir):
    """Orders of one priority are one table: those whose versions differ get a commit, the others none."""
    old, new = version_1(spark, sf_dir), version_2(spark, sf_dir)
    changed = version_diff(old, new, ["o_orderkey", "o_orderpriority"]).groupBy("o_orderpriority")
    counts = changed.agg(*[F.count_if(F.col("change") == c).alias(c) for c in ("added", "removed", "changed")])
    tables = table(spark, sf_dir, "orders").select("o_orderpriority").distinct().join(counts, "o_orderpriority", "left")
    total = F.coalesce(F.col("added") + F.col("removed") + F.col("changed"), F.lit(0))
    return versions.new_commits(tables, total).withColumn("message", F.concat(F.lit("update "), "o_orderpriority"))


_COMMIT_SQL = f"""
select p as o_orderpriority, count(*) filter (change = 'added') as added, count(*) filter (change = 'removed') as removed,
       count(*) filter (change = 'changed') as changed, 'update ' || p as message
from (select coalesce(a.o_orderpriority, b.o_orderpriority) as p,
             case when a.o_orderkey is null then 'added' when b.o_orderkey is null then 'removed' else 'changed' end as change
      from ({V1_SQL}) a full join ({V2_SQL}) b on a.o_orderkey = b.o_orderkey
      where a.o_orderkey is null or b.o_orderkey is null or a.o_totalprice <> b.o_totalprice) group by p"""


def version_drift(spark, sf_dir):
    """Each customer's newest order when a model was trained, against the newest one now."""
    orders = table(spark, sf_dir, "orders")
    cutoff = F.lit("2001-06-01 00:00:00").cast("timestamp_ntz")
    trained = orders.filter(F.col("o_orderdate") < cutoff).groupBy("o_custkey").agg(F.max("o_orderkey").alias("version"))
    current = orders.groupBy("o_custkey").agg(F.max("o_orderkey").alias("version"))
    return versions.version_drift(trained, current, ["o_custkey"])


def tag_add(spark, sf_dir):
    """Model tags of parts: economy parts are tagged already, promo parts have no known commit."""
    part = table(spark, sf_dir, "part").select(
        F.concat(F.lit("model-"), "p_brand", F.lit("-v"), F.col("p_size").cast("string"), F.lit("-data")).alias("tag"),
        F.when(F.col("p_type") == "PROMO", "unknown").otherwise(F.md5("p_name")).alias("commit_id"),
        "p_type",
    )
    have = part.filter(F.col("p_type") == "ECONOMY").groupBy("tag").agg(F.min("commit_id").alias("commit_id"))
    return versions.add_tags(have, part.filter(F.col("p_type") != "ECONOMY"))


_TAG_SQL = """
with t as (select 'model-' || p_brand || '-v' || cast(p_size as varchar) || '-data' as tag, md5(p_name) as commit_id, p_type from part),
     have as (select tag, min(commit_id) as commit_id from t where p_type = 'ECONOMY' group by tag)
select tag, commit_id from have union all
select tag, min(commit_id) from t where p_type not in ('ECONOMY', 'PROMO') and tag not in (select tag from have) group by tag"""

_KINDS = ("view", "click", "purchase", "error", "signup")


def run_lineage(spark, sf_dir):
    """A user is a run, an event type a metric's name."""
    entries = table(spark, sf_dir, "events").select(
        F.col("user_id").alias("run_id"), F.col("event_type").alias("key"), "value", "ts", "event_id"
    )
    return lineage.run_table(entries, {k: f"{k}_value" for k in _KINDS}, order=("ts", "event_id"))


def model_latest(spark, sf_dir):
    models = table(spark, sf_dir, "part").select(F.col("p_brand").alias("model"), F.col("p_size").cast("string").alias("version"))
    return lineage.latest_versions(models)


QUERIES = [
    Query("version_diff", diff_rows, _DIFF_SQL),
    Query(
        "bag_diff", diff_bags,
        """
select *, cast(sum(case when l_returnflag = 'A' then 1 else -1 end) as bigint) as copies
from lineitem where l_returnflag in ('A', 'N') group by all""",
    ),
    Query(
        "version_diff_types", diff_types,
        "select o_orderkey, 'changed' as change from orders where cast(cast(o_orderkey + 9007199254740992 as double) as hugeint) <> o_orderkey + 9007199254740992",
    ),
    Query("version_diff_stored", diff_stored, _DIFF_SQL),
    Query("snapshot_latest", snapshot_latest, _LATEST_SQL),
    Query("ref_resolve", ref_resolve, _RESOLVE_SQL),
    Query("as_of_read", as_of_read, V1_SQL),
    Query("commit_log", commit_log, _COMMIT_SQL),
    Query(
        "version_drift", version_drift,
        """
select o_custkey, max(o_orderkey) filter (o_orderdate < timestamp '2001-06-01 00:00:00') as trained_version,
       max(o_orderkey) as current_version, trained_version is distinct from current_version as drifted
from orders group by o_custkey having trained_version is not null""",
    ),
    Query("tag_add", tag_add, _TAG_SQL),
    Query(
        "run_lineage", run_lineage,
        "select user_id as run_id, " + ", ".join(f"arg_max(value, (ts, event_id)) filter (event_type = '{k}') as {k}_value" for k in _KINDS)
        + " from events group by user_id",
    ),
    Query("model_latest", model_latest, "select p_brand as model, max(p_size) as version from part group by p_brand"),
]
