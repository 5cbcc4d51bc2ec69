"""Build and publish both marts in one run (the production entry point).

Each mart is written as a new immutable version (`sources/store.py`).  The
checks run inside the writing plans: a lookup key that occurs twice fails the
write, and the row counts observed while writing must agree (a lookup neither
adds nor loses rows).  Only when both versions are complete are both views
pointed at them, so a failed build leaves both marts as they were.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

from planmart.plans import marts, quality
from planmart.plans.planning import Plan
from planmart.session import shared_dir
from planmart.sources.store import MartStore, Version

VIEW_NAMES = {"revenue": "revenue_summary", "opportunity": "opportunity_summary"}
#: The step whose rows each mart has: its lookups add columns only.
GRAIN = {"revenue": "p12_all_transactional", "opportunity": "p14_opportunity_detail"}


class RowsChanged(Exception):
    """A mart has other rows than the step that its lookups were joined to."""


def publish_marts(plan: Plan, out_dir: str | None = None, store: MartStore | None = None) -> dict[str, int]:
    """Write and show view 1 and view 2; returns the row counts of both and of the steps behind
    them, from metrics observed while they are written.

    The revenue aggregate is computed once for both (``Plan.persisted``).  The
    counts are kept with each version.  `store` is where the marts live; by default
    one below `out_dir`, else below a new shared folder.
    """
    spark: SparkSession = plan.inputs.revenue.sparkSession
    store = store or MartStore(spark, out_dir or shared_dir(spark, "marts"))
    checked = Plan(plan.raw, plan.opts.with_(unique_lookups=True), plan.given_p1)
    counts: dict[str, int] = {}
    staged: list[Version] = []
    with checked.persisted():
        checked.observations = {}
        for key, mart in (("revenue", marts.revenue_summary(checked)),
                          ("opportunity", marts.opportunity_summary(checked))):
            observed, obs = quality.observed(mart, key)

            def agree(_, key=key, obs=obs) -> dict[str, str]:
                counts[key] = obs.get["rows"]
                counts[GRAIN[key]] = checked.observations[GRAIN[key]].get["rows"]
                if counts[key] != counts[GRAIN[key]]:
                    raise RowsChanged(f"{key}: {counts[key]} rows from {counts[GRAIN[key]]} of {GRAIN[key]}")
                return {"rows": str(counts[key])}

            staged.append(store.stage(observed, VIEW_NAMES[key], ("Fiscal_Year",), agree))
        counts |= {step: obs.get["rows"] for step, obs in checked.observations.items()}
    for version in staged:
        store.show(version)
    return counts
