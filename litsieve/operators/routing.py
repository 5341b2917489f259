"""Routes of reviewed records and the gate before a digest goes out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from litsieve.operators.review import DECISIONS


def route(unknown: str = "review") -> Column:
    """Route of a record; a decision outside the three goes to ``unknown``."""
    decision = F.col("final_decision")
    return F.when(decision.isin(*DECISIONS), decision).otherwise(unknown)


def route_counts(reviewed: DataFrame, unknown: str = "review") -> DataFrame:
    return reviewed.groupBy(route(unknown).alias("route")).agg(F.count(F.lit(1)).alias("n"))


def digest_input(reviewed: DataFrame, include_review: bool = True) -> DataFrame:
    """Records of the digest; ``part`` puts kept ones ahead of those under review."""
    routed = reviewed.withColumn("part", F.when(route() == "keep", 0).when(route() == "review", 1))
    return routed.where(F.col("part") <= (1 if include_review else 0))


def delivery_blocked(reviewed: DataFrame, allow_review_pending: bool = False) -> bool:
    """A waiting review queue stops delivery unless that is allowed."""
    if allow_review_pending:
        return False
    return not reviewed.where(route() == "review").limit(1).isEmpty()
