"""User documents with campaign membership."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.functions.dates import first_day, shift_month
from tagloom.operators.aggregates import explode_members
from tagloom.operators.joins import Salt, left_join

# The status of a campaign that reached its users, and the window when only a period is set.
REACHED = "NOTERESSUC"
DEFAULT_WINDOW_MONTHS = 6


def window_start(period: str | None, months: int | None, today: dt.date) -> dt.date | None:
    """First send day that counts: ``months`` before the period, or before today; none if neither is set."""
    if period:
        return first_day(shift_month(period, -(DEFAULT_WINDOW_MONTHS if months is None else months)))
    if months is None:
        return None
    month = first_day(shift_month(today.strftime("%Y%m"), -months))
    next_month = first_day(shift_month(month.strftime("%Y%m"), 1))
    return month.replace(day=min(today.day, (next_month - dt.timedelta(days=1)).day))


def action_filter(actions: DataFrame, status_column: str = "bstatus", since: dt.date | None = None) -> DataFrame:
    """Campaign actions that reached their users, sent on or after ``since``."""
    reached: Column = F.col(status_column) == F.lit(REACHED)
    if since is not None:
        reached = reached & (F.col("send_time") >= F.lit(since))
    return actions.where(reached)


def batches_of(batches: DataFrame, actions: DataFrame) -> DataFrame:
    """The batches with at least one of the actions, rows as they are."""
    return batches.join(actions.select("atid"), "atid", "left_semi")


def batch_actions(batches: DataFrame, actions: DataFrame) -> DataFrame:
    """The distinct ``(atid, userids)`` of batches with at least one of the actions."""
    return batches_of(batches, actions).select("atid", "userids").distinct()


def markets_by_user(batches: DataFrame, actions: DataFrame, salt: Salt | None = None) -> DataFrame:
    """``(userid, markets)``: the distinct campaigns of each user, sorted.

    Batches are not made distinct first: the pairs are, which covers it and spares a shuffle of the
    long user lists. With ``salt``, hot users get one row per salt, ready for a salted join.
    """
    pairs = (
        explode_members(batches_of(batches, actions), "userids", "atid")
        .where(F.col("atid").isNotNull())
        .select(F.col("userids").alias("id"), F.col("atid").alias("market"))
        .distinct()
    )
    keys = ["id"]
    if salt is not None:
        pairs = salt.right(pairs, "id")
        keys = [c for c in pairs.columns if c != "market"]
    return pairs.groupBy(*keys).agg(F.array_join(F.sort_array(F.collect_list("market")), ",").alias("markets"))


def user_markets(
    user_labels: DataFrame, batches: DataFrame, actions: DataFrame, salted: bool = True
) -> DataFrame:
    """``(id, labels, markets)`` for every labelled user; null without campaigns."""
    users = user_labels.select("id", "labels")
    salt = Salt.of(users, "id") if salted else None
    left = users if salt is None else salt.left(users, "id")
    return left_join(left, markets_by_user(batches, actions, salt), "id", salt).select("id", "labels", "markets")
