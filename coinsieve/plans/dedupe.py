"""Duplicate removal, by key alone or with a judging function."""

from __future__ import annotations

from pyspark.sql import DataFrame

from coinsieve.operators.dedupe import dedupe_adjudicated, dedupe_exact, duplicate_groups, group_members
from coinsieve.operators.enrich import GroupJudge, RowReply, adjudicate, adjudicate_streamed


def dedupe(
    txns: DataFrame, mode: str = "exact", judge: RowReply | type[GroupJudge] | None = None, null_keys: str = "keep",
    members_per_part: int | None = None, **calls,
) -> DataFrame:
    """One row per duplicate group, except groups the judge calls different.

    A function judges groups as one value each, a ``GroupJudge`` class as streams.
    """
    if mode == "exact":
        return dedupe_exact(txns, null_keys)
    if mode != "adjudicated" or judge is None:
        raise ValueError("mode is 'exact', or 'adjudicated' with a judge")
    if isinstance(judge, type) and issubclass(judge, GroupJudge):
        return dedupe_adjudicated(txns, adjudicate_streamed(group_members(txns), judge, **calls))
    return dedupe_adjudicated(txns, adjudicate(duplicate_groups(txns, members_per_part), judge, **calls))
