"""Registered queries: Structured Streaming over landed worker files.

Each query lands rows derived from the driver tables as several Parquet
files (the way worker batches arrive), runs the streaming job until the
folder is drained (``availableNow``), and returns the sink's result, which
must equal the batch computation.
"""

from __future__ import annotations

from hypercube.plans import oracle_sql as o
from hypercube.plans.queries import register
from hypercube.plans.study import BATCH_SIZE, Study
from hypercube.streaming import incremental as inc


def _landed_hourly(spark, st: Study) -> str:
    return st.landed_hourly()


@register("progress_stream", o.q(("fx_design", "fx_summary"), f"""
tot AS (SELECT CAST(ceil(sim_id / {BATCH_SIZE}.0E0) AS INTEGER) AS batch_id, count(*) AS n_total FROM fx_design GROUP BY 1),
dn AS (SELECT CAST(ceil(sim_id / {BATCH_SIZE}.0E0) AS INTEGER) AS batch_id, count(*) AS n_done FROM fx_summary GROUP BY 1)""",
                                   select=f"""
SELECT t.batch_id, coalesce(d.n_done, 0) AS n_done, t.n_total,
  {o.re_sql('least(coalesce(d.n_done, 0), t.n_total) * 100.0E0 / t.n_total', 2)} AS pct_done
FROM tot t LEFT JOIN dn d ON t.batch_id = d.batch_id"""))
def q_progress_stream(spark, sf_dir):
    """T1 + A18: study progress from summary files as they land."""
    st = Study(spark, sf_dir)
    return inc.stream_progress(spark, st.landed_summary(), st.design, BATCH_SIZE, st.files_per_trigger())


@register("stream_run_stats", o.q(o.HOURLY_FX, o.cte_hourly(), select="SELECT * FROM rs"))
def q_stream_run_stats(spark, sf_dir):
    """Per-run sums and earliest peak carried from epoch to epoch."""
    st = Study(spark, sf_dir)
    return inc.stream_run_stats(spark, _landed_hourly(spark, st), st.files_per_trigger())


@register("stream_sparse_append", o.q(o.HOURLY_FX + o.ZONE_FX, o.CTE_ZONES, o.cte_hourly(), o.cte_sparse(),
                                      select="SELECT * FROM sp"))
def q_stream_sparse_append(spark, sf_dir):
    """The sparse fact appended micro-batch by micro-batch."""
    st = Study(spark, sf_dir)
    return inc.stream_sparse_append(spark, _landed_hourly(spark, st), st.published("zone_catalog"), st.files_per_trigger())
