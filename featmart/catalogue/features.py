"""Feature engineering, normalization, synthetic features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.sql_functions import register_functions
from ..operators import features as ops
from ..operators import mergeable, normalize
from ..sources.files import run_query
from ..sources.synthetic import correlated_features
from ..workdir import cut
from .base import FEAT_SQL, FEATURES, GAPS_SQL, Query, feat, gaps, rounded, table

_N = len(FEATURES)
_NUMBERED_SQL = "select sample_id, " + ", ".join(f"{f} as syscall_{i}" for i, f in enumerate(FEATURES, 1)) + f" from ({GAPS_SQL})"
_NORMALIZED_SQL = "select sample_id, " + ", ".join(
    f"cast(coalesce(syscall_{i}, 0) as float) as syscall_{i}_normalized" for i in range(1, _N + 1)
) + f" from ({_NUMBERED_SQL})"
_TOTAL = "(" + " + ".join(f"cast(syscall_{i}_normalized as double)" for i in range(1, _N + 1)) + ")"
_LIST = "[" + ", ".join(f"cast(syscall_{i}_normalized as double)" for i in range(1, _N + 1)) + "]"


def _numbered(spark, sf_dir):
    return gaps(spark, sf_dir).select("sample_id", *[F.col(f).alias(f"syscall_{i}") for i, f in enumerate(FEATURES, 1)])


def feat_norm_cols(spark, sf_dir):
    rows = _numbered(spark, sf_dir)
    return rows.select("sample_id", *ops.normalized_columns(rows, "syscall", _N))


def feat_safe_cols(spark, sf_dir):
    rows = gaps(spark, sf_dir)
    return rows.select("sample_id", *ops.safe_columns(rows, FEATURES))


def feat_row_stats(spark, sf_dir):
    rows = ops.with_row_statistics(_numbered(spark, sf_dir), "syscall", _N)
    return rows.select(
        "sample_id", rounded("syscall_total").alias("syscall_total"), rounded("syscall_mean").alias("syscall_mean"),
        rounded("syscall_variance", 4).alias("syscall_variance"), "is_high_activity",
    )


def feat_on_demand(spark, sf_dir):
    rows = ops.with_on_demand_scores(gaps(spark, sf_dir))
    return rows.select("sample_id", "syscall_activity_score", "is_high_syscall_activity", "network_activity_score", "permission_risk_score")


_ON_DEMAND_SQL = f"""
select sample_id, cast(a as double) as syscall_activity_score, cast(case when a > 1000 then 1 else 0 end as bigint) as is_high_syscall_activity,
       cast(n as double) as network_activity_score, cast(p as double) as permission_risk_score
from (select sample_id,
             coalesce(read, 0) + coalesce(write, 0) + coalesce(open, 0) + coalesce(close, 0) + coalesce(clone, 0) + coalesce(socket, 0) as a,
             coalesce(socket, 0) + coalesce(sendto, 0) + coalesce(bind, 0) as n,
             coalesce(send_sms, 0) + coalesce(camera, 0) as p
      from ({GAPS_SQL}))"""


def feat_autodiscover(spark, sf_dir):
    """No requested column exists, so the numeric ones are taken; their sums stand for them."""
    lines = table(spark, sf_dir, "lineitem")
    names = ops.choose_features(lines, requested=["syscall_1_normalized"], exclude=[*ops.NOT_FEATURES, "l_orderkey"])
    return lines.agg(*[F.round(F.sum(F.col(c).cast("double")), 2).alias(c) for c in names])


def norm_stats(spark, sf_dir):
    rows = normalize.column_statistics(feat(spark, sf_dir), FEATURES)
    return rows.select("feature", rounded("mean").alias("mean"), rounded("std").alias("std"))


def norm_stats_merged(spark, sf_dir):
    """The same from the states of three parts, without their rows."""
    rows = feat(spark, sf_dir)
    states = [cut(mergeable.moments_state(rows.where(F.col("sample_id") % 3 == i), FEATURES), "moments") for i in range(3)]
    merged = mergeable.merge_moments(mergeable.merge_moments(*states[:2]), states[2])
    return mergeable.moments_of(merged).select("feature", rounded("mean").alias("mean"), rounded("std").alias("std"))


def feat_norm_cols_sql(spark, sf_dir):
    """Normalized columns in SQL alone, by the registered functions."""
    register_functions(spark, "feat_")
    _numbered(spark, sf_dir).createOrReplaceTempView("featmart_numbered")
    columns = ", ".join(f"feat_clean_value(syscall_{i}) as syscall_{i}_normalized" for i in range(1, _N + 1))
    return run_query(spark, f"select sample_id, {columns} from featmart_numbered")


def feat_sums_sql(spark, sf_dir):
    """Sum and mean over normalized columns, and chosen features of a map, in SQL alone."""
    register_functions(spark, "feat_")
    gaps(spark, sf_dir).createOrReplaceTempView("featmart_gaps")
    listed = ", ".join(f"cast({f} as double)" for f in FEATURES)
    named = ", ".join(f"'{f}', cast({f} as double)" for f in FEATURES)
    return run_query(
        spark,
        f"""select sample_id, feat_sum_features(feat_normalized_columns(array({listed}))) as total, round(feat_mean_features(feat_coalesce_columns(array({listed}), 1D)), 6) as mean,
                   feat_select_features(map({named}), array('bind', 'nothing'))[0] as bind
            from featmart_gaps""",
    )


_SUMS_SQL = f"""
select sample_id, cast({' + '.join(f'coalesce({f}, 0)' for f in FEATURES)} as double) as total,
       round(({' + '.join(f'coalesce({f}, 1)' for f in FEATURES)}) / {len(FEATURES)}.0::double, 6) as mean, cast(bind as double) as bind
from ({GAPS_SQL})"""
_STATS_SQL = " union all ".join(
    f"select '{f}' as feature, round(avg(cast({f} as double)), 6) as mean, round(stddev_pop(cast({f} as double)) + 1e-8, 6) as std from feat"
    for f in FEATURES
)


def norm_apply(spark, sf_dir):
    rows = cut(gaps(spark, sf_dir), "features")
    fit = normalize.fit_normalizer(rows, FEATURES)
    return normalize.apply_normalizer(rows, fit).select("sample_id", *[rounded(f).alias(f) for f in FEATURES])


_APPLY_SQL = (
    f"with g as (select sample_id, {', '.join(f'cast(coalesce({f}, 0) as double) as {f}' for f in FEATURES)} from ({GAPS_SQL})), "
    f"s as (select {', '.join(f'avg({f}) as m_{f}, stddev_pop({f}) + 1e-8 as s_{f}' for f in FEATURES)} from g) "
    f"select sample_id, {', '.join(f'round(({f} - m_{f}) / s_{f}, 6) as {f}' for f in FEATURES)} from g, s"
)
_Z = ["clone", "bind"]


def feat_zscore(spark, sf_dir):
    rows = normalize.zscore(cut(gaps(spark, sf_dir).select("sample_id", *_Z), "features"), [*_Z, "absent_column"])
    return rows.select("sample_id", *[rounded(c).alias(c) for c in _Z])


_ZSCORE_SQL = f"""
with g as ({GAPS_SQL}), s as (select avg(clone) as mc, stddev_samp(clone) as sc, avg(bind) as mb, stddev_samp(bind) as sb from g)
select sample_id, round((clone - mc) / sc, 6) as clone, round((bind - mb) / sb, 6) as bind from g, s"""


def tbl_describe(spark, sf_dir):
    rows = normalize.describe(table(spark, sf_dir, "lineitem"))
    return rows.select("column_name", "count", rounded("mean", 4).alias("mean"), rounded("std", 4).alias("std"), "min", "max")


_DESCRIBE_SQL = " union all ".join(
    f"select '{c}' as column_name, count({c}) as count, round(avg({c}), 4) as mean, round(stddev_samp({c}), 4) as std, "
    f"cast(min({c}) as double) as min, cast(max({c}) as double) as max from lineitem"
    for c in ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
)


def map_features(spark, sf_dir):
    rows = feat(spark, sf_dir).select("sample_id", ops.feature_map(FEATURES).alias("features"))
    return rows.select(
        "sample_id",
        F.size("features").alias("n_features"),
        ops.map_value("features", "clone").alias("clone"),
        ops.map_value("features", "not_a_feature").alias("missing"),
    )


_D = 6


def synth_corr(spark, sf_dir):
    """One synthetic row per document, z-scored with population statistics."""
    rows = cut(correlated_features(table(spark, sf_dir, "documents"), "doc_id", _D, 42), "synthetic")
    names = [f"f_{i}" for i in range(_D)]
    stats = rows.agg(*[F.avg(c).alias(f"m_{c}") for c in names], *[F.stddev_pop(c).alias(f"s_{c}") for c in names]).first()
    return rows.select("doc_id", *[rounded((F.col(c) - stats[f"m_{c}"]) / (stats[f"s_{c}"] + 1e-8), 5).alias(c) for c in names])


def _uniform_sql(stream: str) -> str:
    return f"((cast('0x' || substr(md5('42|{stream}|' || cast(doc_id as varchar)), 1, 8) as bigint) + 0.5::double) / 4294967296.0::double)"


def _normal_sql(i: int) -> str:
    return f"sqrt(-2.0::double * ln({_uniform_sql(f'{i}a')})) * cos(2 * pi() * {_uniform_sql(f'{i}b')})"


_SYNTH_SQL = (
    "with n as (select doc_id, " + ", ".join(f"{_normal_sql(i)} as n_{i}" for i in range(_D)) + " from documents), "
    "r as (select doc_id, "
    + ", ".join(f"0.5::double * n_{i} as f_{i}, 0.8::double * 0.5::double * n_{i} + 0.2::double * n_{i + 1} as f_{i + 1}" for i in range(0, _D, 2))
    + " from n), s as (select " + ", ".join(f"avg(f_{i}) as m_{i}, stddev_pop(f_{i}) + 1e-8 as s_{i}" for i in range(_D)) + " from r) "
    "select doc_id, " + ", ".join(f"round((f_{i} - m_{i}) / s_{i}, 5) as f_{i}" for i in range(_D)) + " from r, s"
)


QUERIES = [
    Query("feat_norm_cols", feat_norm_cols, _NORMALIZED_SQL),
    Query("feat_norm_cols_sql", feat_norm_cols_sql, _NORMALIZED_SQL),
    Query("feat_sums_sql", feat_sums_sql, _SUMS_SQL),
    Query(
        "feat_safe_cols",
        feat_safe_cols,
        f"select sample_id, {', '.join(f'cast(coalesce({f}, 0) as float) as {f}_safe' for f in FEATURES)} from ({GAPS_SQL})",
    ),
    Query(
        "feat_row_stats",
        feat_row_stats,
        f"""
select sample_id, round({_TOTAL}, 6) as syscall_total, round({_TOTAL} / {_N}.0::double, 6) as syscall_mean,
       round(list_var_pop({_LIST}), 4) as syscall_variance, case when {_TOTAL} > 100 then 1 else 0 end as is_high_activity
from ({_NORMALIZED_SQL})""",
    ),
    Query("feat_on_demand", feat_on_demand, _ON_DEMAND_SQL),
    Query(
        "feat_autodiscover",
        feat_autodiscover,
        """
select round(sum(l_discount), 2) as l_discount, round(sum(l_extendedprice), 2) as l_extendedprice,
       cast(sum(l_linenumber) as double) as l_linenumber, cast(sum(l_partkey) as double) as l_partkey, round(sum(l_quantity), 2) as l_quantity,
       cast(sum(l_suppkey) as double) as l_suppkey, round(sum(l_tax), 2) as l_tax
from lineitem""",
    ),
    Query("norm_stats", norm_stats, f"with feat as ({FEAT_SQL}) {_STATS_SQL}"),
    Query("norm_stats_merged", norm_stats_merged, f"with feat as ({FEAT_SQL}) {_STATS_SQL}"),
    Query("norm_apply", norm_apply, _APPLY_SQL),
    Query("feat_zscore", feat_zscore, _ZSCORE_SQL),
    Query("tbl_describe", tbl_describe, _DESCRIBE_SQL),
    Query(
        "map_features",
        map_features,
        f"select sample_id, {_N} as n_features, cast(clone as double) as clone, cast(null as double) as missing from ({FEAT_SQL})",
    ),
    Query("synth_corr", synth_corr, _SYNTH_SQL),
]
