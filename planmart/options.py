"""Behaviour switches; the defaults reproduce the worksheet faithfully."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class PlanOptions:
    # Run-rate grain: "origin" keeps one row per origin month (the worksheet's
    # double counting when joined), "summed" adds origins per target month.
    rr_grain: str = "origin"
    # Keep opportunities dated later in the cutoff month itself in the run rate.
    include_current_month: bool = True
    # Drop run-rate rows shifted past the end of the current fiscal year.
    clip_to_fy: bool = False
    # Reproduce the two missing commas of the opportunity view (26 columns).
    compat_aliases: bool = False
    # Drop Inactive projects from the opportunity view (the worksheet keeps them).
    drop_inactive_in_summary: bool = False
    # Label for NULL amounts in the value bands (None: the top band, as the worksheet).
    null_band: str | None = None
    # Optional Spark collation for text rules, e.g. "UTF8_LCASE_RTRIM".
    collation: str | None = None
    # Collation of the planning keys (account numbers, target categories) in joins and groupings,
    # e.g. "UTF8_LCASE_RTRIM": keys that are equal under it are one key.  None: binary.
    key_collation: str | None = None
    # Fail a build in which a calendar, account or seller lookup holds a key twice (its
    # rows would multiply); off, rows multiply as in the worksheet.  `publish_marts` turns it on.
    unique_lookups: bool = False
    # "null": unparsable amounts become NULL (and show in the audit); "fail": raise on whatever the audit lists.
    on_bad: str = "null"
    # How P12 merges its five inputs: "cogroup" (FULL OUTER JOIN semantics, one
    # shuffle), "join" (nested FULL OUTER JOINs), "union" (summed, one shuffle).
    combine: str = "cogroup"

    def with_(self, **kw) -> "PlanOptions":
        return replace(self, **kw)


DEFAULT = PlanOptions()
