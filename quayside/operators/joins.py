"""Joins that stay correct and balanced whatever the key distribution."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def lookup(left: DataFrame, dim: DataFrame, key: str, columns: dict[str, str], dim_key: str | None = None) -> DataFrame:
    """Left join of a few dimension columns, renamed by `columns` (dim name -> output name).

    No hint is given: Catalyst broadcasts the dimension while its size statistics allow it,
    and adaptive execution re-decides at run time (or splits a hot key) beyond that.
    """
    right = dim.selectExpr(f"{dim_key or key} as {key}", *[f"{c} as {n}" for c, n in columns.items()])
    return left.join(right, key, "left")


def match_to_jobs(rows: DataFrame, row_id: str, jobs: DataFrame) -> DataFrame:
    """Left join of rows to jobs on the job reference as typed; `jobs.job_number` is dropped.

    A missing reference can match nothing, yet an outer join would send every such row to
    one task, so each row without one joins on its own placeholder. The prefixed key also
    gives both sides an exchange of their own whatever partitioning they arrive in, which is
    what lets adaptive execution split a job that holds a large share of the rows.
    """
    left = rows.withColumn(
        "match_key", F.expr(f"coalesce(concat('job:', job_number), concat('row:', cast({row_id} as string)))")
    ).drop("job_number")  # the key holds it; one of the two is shuffled
    reference = "if(startswith(match_key, 'job:'), substring(match_key, 5), null) as job_number"
    kept = [reference if c == "job_number" else c for c in rows.columns]
    right = jobs.selectExpr("concat('job:', job_number) as match_key", *[c for c in jobs.columns if c != "job_number"])
    return left.join(right, "match_key", "left").selectExpr(*kept, *[c for c in jobs.columns if c != "job_number"])


def orphan_keys(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """Child keys with no parent and how many rows carry each; missing keys never match.

    Rows are counted per key before the shuffle, so a key held by a third of the rows
    travels as one count per task.
    """
    counted = child.groupBy(key).agg(F.expr("count(*) as row_count"))
    return counted.join(parent.selectExpr(f"{parent_key or key} as {key}"), key, "left_anti")
