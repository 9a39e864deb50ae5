"""Quality reports on a finished schedule and on channels without one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import names, titles
from . import schedule as S

#: Ordered rules of why a channel has no schedule: reason, pattern on the name. A parameter of ``missing_reason``.
MISSING_RULES = (
    ("foreign", r"(?i)^(?:PT|US|USA|UK|CO|ARG|AR|MX|UY|CL|DE|ES|FR|IT|CA|JP)\b"), ("event", r"(?i)\b(?:PPV|EVENTOS?|JOGO|24\s*H|LIVE|CAMERA)\b"),
    ("list_duplicate", r"(?i)\b(?:SPORTS?|ESPORTES?)\s*\d{2}\b"), ("regional", r"(?i)\b(?:REDE|TV)\s"),
)


def missing_reason(name: Column, failed_sources: Column, rules: tuple[tuple[str, str], ...] = MISSING_RULES) -> Column:
    """First reason that holds; failed sources count before regional names, 'no_content' is the rest."""
    out = F.when(F.coalesce(name, F.lit("")) == "", "unnamed")
    for reason, pattern in rules:
        if reason == "regional":
            out = out.when(failed_sources > 0, "source_failed")
        out = out.when(name.rlike(pattern), reason)
    return out.otherwise("no_content")


def gap_reason(n_candidates: Column, supporters: Column, voters: Column, lowest_health: Column, n_rows: Column) -> Column:
    """Why a channel has gaps: one source only, sources that disagree, gaps in all sources, or common gaps."""
    return (
        F.when(n_rows <= 10, "few_rows").when(n_candidates <= 1, "single_source").when((voters >= 3) & (supporters / F.greatest(voters, F.lit(1)) < 0.55), "sources_disagree")
        .when(lowest_health < 0.95, "gaps_in_all_sources").otherwise("common_gap")
    )


def summary(rows: DataFrame, now: int = S.CLOCK, least_hours: float = 12.0) -> DataFrame:
    """Per channel: rows, whether something is on and next, hours ahead, gaps over 2 minutes with the longest, overlaps, placeholders."""
    b = S.breaks(rows).groupBy(*S.KEYS).agg(
        F.count_if(F.col("kind") == "gap").alias("gap_count"), F.coalesce(F.max(F.when(F.col("kind") == "gap", F.expr("seconds div 60"))), F.lit(0)).alias("longest_gap_min"),
        F.count_if(F.col("kind") == "overlap").alias("overlap_count"))
    s, e = F.col("s"), F.col("e")
    base = rows.groupBy(*S.KEYS).agg(
        F.count("*").alias("n_rows"), F.max(F.when((s <= now) & (e > now), 1).otherwise(0)).alias("has_now"), F.max(F.when(s > now, 1).otherwise(0)).alias("has_next"),
        F.round(F.coalesce(F.max(F.when(e > now, e)) - now, F.lit(0)) / F.lit(3600.0), 1).alias("future_hours"), F.count_if(~titles.is_programme(F.col("norm"))).alias("placeholders"))
    j = base.join(b, list(S.KEYS), "left").fillna(0, ["gap_count", "longest_gap_min", "overlap_count"])
    return j.withColumn("short", F.col("future_hours") < least_hours)


def totals(per_channel: DataFrame) -> DataFrame:
    """One row: channels, those with nothing on, with gaps, with overlaps, short ones, and all placeholders."""
    return per_channel.agg(
        F.count("*").alias("channels"), F.count_if(F.col("has_now") == 0).alias("nothing_on"), F.count_if(F.col("gap_count") > 0).alias("with_gaps"),
        F.count_if(F.col("overlap_count") > 0).alias("with_overlaps"), F.count_if("short").alias("short"), F.sum("placeholders").alias("placeholders"))


def validation_lookup(channels: DataFrame, validation: DataFrame) -> DataFrame:
    """source, channel_id, target: by a display name in small letters, else by its plain key; the first target counts.

    validation: target, name.
    """
    v = validation.filter("name IS NOT NULL")
    exact = v.groupBy(F.lower("name").alias("x")).agg(F.min("target").alias("t1"))
    loose = v.select(names.plain_key(F.col("name")).alias("y"), "target").filter("y != ''").groupBy("y").agg(F.min("target").alias("t2"))
    c = channels.select("source", "channel_id", F.explode("display_names").alias("n")).withColumn("x", F.lower("n")).withColumn("y", names.plain_key(F.col("n")))
    j = c.join(exact, "x", "left").join(loose, "y", "left")
    return j.groupBy("source", "channel_id").agg(F.coalesce(F.min("t1"), F.min("t2")).alias("target")).filter("target IS NOT NULL")
