"""Plans over change events."""

from __future__ import annotations

from pyspark.sql import DataFrame

from freshet import schemas as S
from freshet.operators.decode import current_rows, decode_changes, row_versions
from freshet.plans.base import plan
from freshet.streaming.processors import newest_changes

CHANGE_LOG = S.schema(value="string", offset="long")


@plan(CHANGE_LOG)
def change_events(df: DataFrame) -> DataFrame:
    return decode_changes(df, S.CHANGED_ROW)


ORDER = ("ts", "offset")


def _changes_on_stream(df: DataFrame) -> DataFrame:
    return newest_changes(decode_changes(df, S.CHANGED_ROW), "id", ORDER)


@plan(CHANGE_LOG, on_stream=_changes_on_stream)
def changed_table(df: DataFrame) -> DataFrame:
    """The table the changes leave behind; on a stream the states that each micro-batch has changed."""
    return current_rows(decode_changes(df, S.CHANGED_ROW), "id", ORDER)


@plan(CHANGE_LOG, mode="batch")
def changed_versions(df: DataFrame) -> DataFrame:
    """Every state of every row, and from when to when it was so."""
    return row_versions(decode_changes(df, S.CHANGED_ROW), "id", ORDER)
