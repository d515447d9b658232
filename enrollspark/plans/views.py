"""The extract's intermediate results as temporary views for SQL (SRC-6).

A run registers its views, SQL reads them by name, and they are dropped when the run is over::

    with extract_views(spark, demo, elig, prpr, prrg, as_of) as sql:
        sql("SELECT STATE_ID, count(*) AS records FROM records GROUP BY STATE_ID").write.parquet(path)

A view is a plan, not a copy: a query over it is planned as a whole, with pushdown and
pruning through the view.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

from enrollspark.operators.change import member_timeline, with_composite_keys
from enrollspark.operators.optional import cob_top, cob_with_members
from enrollspark.operators.providers import latest_registration, with_registration
from enrollspark.operators.records import cob_records, demo_records, elig_records, merge_records, with_body
from enrollspark.operators.spans import active_members, span_detail

# the views of a run; those of COB only where the run has it
VIEWS = ("demo", "elig", "cob", "members", "spans", "registrations", "timeline", "policies", "records")


def intermediate_results(demo: DataFrame, elig: DataFrame, prpr: DataFrame, prrg: DataFrame, as_of: dt.date, cob: DataFrame | None = None, strict_width: bool = False) -> dict[str, DataFrame]:
    """The run's intermediate results by name.

    demo, elig, cob  the inputs;
    members          active members, a row for each active span (JN-1);
    spans            their spans with the provider's latest registration (JN-2..4);
    registrations    each provider group's latest registration (JN-5);
    timeline         every member row with every span, and the composite keys (JN-6, PRJ-13);
    policies         the newest COB rows of subscribers in DEMO;
    records          all records of the extract, unsorted (SET-1).
    """
    members = active_members(demo, elig, as_of)
    spans = with_registration(span_detail(elig, demo, as_of), prpr, prrg)
    out = {
        "demo": demo,
        "elig": elig,
        "members": members,
        "spans": spans,
        "registrations": latest_registration(prrg),
        "timeline": with_composite_keys(member_timeline(demo, elig)),
    }
    bodies = with_registration(with_body(span_detail(elig, demo, as_of)), prpr, prrg, printed=True)
    records = [demo_records(members, strict_width), elig_records(bodies)]
    if cob is not None:
        out |= {"cob": cob, "policies": cob_with_members(cob_top(cob), demo)}
        records.append(cob_records(out["policies"]))
    return out | {"records": merge_records(*records)}


@contextmanager
def named_views(spark: SparkSession, frames: dict[str, DataFrame], prefix: str = "") -> Iterator[Callable[[str], DataFrame]]:
    """Register each frame as the temporary view ``prefix`` + name; gives ``spark.sql``, and drops the views at the end, also after an error.

    A view of that name that the session has already is an error, so that no run reads or drops another's;
    runs side by side in one session need prefixes of their own.
    """
    names = [f"{prefix}{n}" for n in frames]
    taken = {t.name for t in spark.catalog.listTables() if t.isTemporary} & set(names)
    if taken:
        raise ValueError(f"the session has views of these names: {', '.join(sorted(taken))}")
    try:
        for name, df in zip(names, frames.values()):
            df.createOrReplaceTempView(name)
        yield spark.sql
    finally:
        for name in names:
            spark.catalog.dropTempView(name)


@contextmanager
def extract_views(
    spark: SparkSession,
    demo: DataFrame,
    elig: DataFrame,
    prpr: DataFrame,
    prrg: DataFrame,
    as_of: dt.date,
    cob: DataFrame | None = None,
    strict_width: bool = False,
    prefix: str = "",
) -> Iterator[Callable[[str], DataFrame]]:
    """The run's views (``intermediate_results``), registered while the block lasts."""
    with named_views(spark, intermediate_results(demo, elig, prpr, prrg, as_of, cob, strict_width), prefix) as sql:
        yield sql
