"""Silver, gold and trend queries (PL1-PL8)."""

from __future__ import annotations

from stormlake import oracles as O
from stormlake.catalog import register
from stormlake.plans import gold, silver, trends
from stormlake.sources import fixtures as X


# --- shared silver inputs --------------------------------------------------
def silver_disaster_df(spark, sf):
    return silver.silver_disaster(X.storm_events_raw(spark, sf))


def silver_base1_daily_df(spark, sf):
    return silver.silver_base1(X.raw_base1_daily(spark, sf))


def silver_base1_hourly_df(spark, sf):
    return silver.silver_base1(X.raw_base1_hourly(spark, sf))


def silver_base2_df(spark, sf):
    return silver.silver_base2(X.raw_base2_daily(spark, sf))


def silver_base3_daily_df(spark, sf):
    return silver.silver_base3(X.raw_base3_daily(spark, sf))


def silver_base3_hourly_df(spark, sf):
    return silver.silver_base3(X.raw_base3_hourly(spark, sf), order_extra=["ord_a", "ord_b", "ord_c"])


# --- PL8: the flagship ------------------------------------------------------
@register("disaster_trend", O.disasters_over_years)
def q_disaster_trend(spark, sf):
    return trends.disasters_over_years(silver_disaster_df(spark, sf))


# --- PL1-PL4: silver --------------------------------------------------------
@register("silver_base1_daily", O.silver_base1)
def q_silver_base1(spark, sf):
    return silver_base1_daily_df(spark, sf)


@register("silver_base1_hourly", O.silver_base1_hourly)
def q_silver_base1_hourly(spark, sf):
    return silver_base1_hourly_df(spark, sf)


@register("silver_base2_daily", O.silver_base2)
def q_silver_base2(spark, sf):
    return silver_base2_df(spark, sf)


@register("silver_base3_daily", O.silver_base3_daily)
def q_silver_base3_daily(spark, sf):
    return silver_base3_daily_df(spark, sf)


@register("silver_base3_hourly", O.silver_base3_hourly)
def q_silver_base3_hourly(spark, sf):
    return silver_base3_hourly_df(spark, sf)


@register("silver_disaster", O.silver_disaster)
def q_silver_disaster(spark, sf):
    return silver_disaster_df(spark, sf)


# --- PL5-PL7: gold ----------------------------------------------------------
@register("gold_base1", O.gold_base1)
def q_gold_base1(spark, sf):
    return gold.gold_base1(silver_base1_daily_df(spark, sf), silver_base1_hourly_df(spark, sf),
                           silver_disaster_df(spark, sf))


@register("gold_base2", O.gold_base2)
def q_gold_base2(spark, sf):
    return gold.gold_base2(silver_base2_df(spark, sf), silver_disaster_df(spark, sf))


@register("gold_base3", O.gold_base3)
def q_gold_base3(spark, sf):
    return gold.gold_base3(silver_base3_daily_df(spark, sf), silver_base3_hourly_df(spark, sf),
                           silver_disaster_df(spark, sf))
