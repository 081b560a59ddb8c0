"""Marketing tables that follow late rows without being built anew.

``build`` makes the clean web events and ads, their campaign tags by day, the campaign bridge, its dimensions and the two
daily facts from everything in bronze. ``refresh`` then brings them up to date with the batches since:

1. the keys of the new batches name the clean rows that may change; these are cleaned again, and the days they had and
   have are the touched ones;
2. clean rows and tags of touched days are written anew, other days stay as files. A day's tags are its distinct campaign
   tuples, so first and last day of a tuple are the least and greatest over the days, and a tuple that vanished is gone;
3. the bridge and the dimensions come from the tags, which are small;
4. the facts of touched days are written anew, and those of days with a campaign whose entry in the dimension changed.

The result is that of a full build. Days are the unit of writing; which ones were touched (one short value each) is the only
thing that reaches the driver.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.operators.cleaning import CleanSpec, clean, tidy
from tidemart.plans import bridges, dims, facts, silver
from tidemart.sources.published import open_table, publish, replace_parts, save_table, state_of
from tidemart.streaming.upserts import Upserted


@dataclass(frozen=True, eq=False)
class Stream:
    """A clean table that is saved by day, and the tuples of it that name campaigns."""

    name: str
    spec: CleanSpec
    day: str
    tags: tuple[str, ...]

    @property
    def tags_name(self) -> str:
        return f"{self.name}_tags"


WEB = Stream("silver_web_events", silver.WEB_EVENTS, "event_date", ("campaign_id", "utm_campaign", "utm_source", "utm_medium"))
ADS = Stream("silver_ads_campaigns", silver.ADS_CAMPAIGNS, "campaign_date", ("campaign_id", "campaign_name", "source", "medium", "channel"))
FACTS = ("fact_marketing_spend_daily", "fact_web_funnel_daily")
#: What facts take from a campaign.
LOOKUP = ("campaign_id", "campaign_key", "channel", "source", "medium")
REFRESHED, USED = "refreshed", "lookup_used"


def _tags(rows: DataFrame, stream: Stream) -> DataFrame:
    return rows.select(*stream.tags, stream.day).distinct()


def _save_lookups(spark: SparkSession, out: str) -> None:
    tags = [open_table(spark, f"{out}/{s.tags_name}") for s in (WEB, ADS)]
    mapping = save_table(bridges.bridge_campaign_mapping(*tags), f"{out}/bridge_campaign_mapping")
    save_table(dims.dim_campaign(mapping), f"{out}/dim_campaign")
    save_table(dims.dim_channel(mapping), f"{out}/dim_channel")


def _facts(spark: SparkSession, out: str, rows: Callable[[Stream], DataFrame]) -> dict[str, DataFrame]:
    campaigns, channels = open_table(spark, f"{out}/dim_campaign"), open_table(spark, f"{out}/dim_channel")
    spend = facts.fact_marketing_spend_daily(rows(ADS), campaigns)
    return dict(zip(FACTS, (spend, facts.fact_web_funnel_daily(rows(WEB), campaigns, channels))))


def _last_batch(spark: SparkSession, bronze: str, stream: Stream) -> int:
    state = Upserted(spark, f"{bronze}/{stream.spec.source}").state
    return max(state["merged"], *map(int, state["deltas"]), -1)


def _remember(spark: SparkSession, bronze: str, out: str) -> None:
    """Notes which batches the tables hold and which lookups the facts were made with."""
    campaigns, channels = open_table(spark, f"{out}/dim_campaign"), open_table(spark, f"{out}/dim_channel")
    save_table(campaigns.select(*LOOKUP), f"{out}/{USED}")
    seen = {s.name: _last_batch(spark, bronze, s) for s in (WEB, ADS)}
    publish(spark, f"{out}/{REFRESHED}", {"seen": seen, "no_channel": _no_channel(channels), "pending": {}})


def _no_channel(channels: DataFrame) -> bool:
    """Whether events without a campaign find a channel."""
    return not channels.filter("channel_name = 'unknown' AND source = 'unknown' AND medium = 'unknown'").isEmpty()


def build(spark: SparkSession, bronze: str, out: str) -> None:
    """All tables from all of bronze (as ``streaming.ingest`` writes it)."""
    for s in (WEB, ADS):
        rows = save_table(clean(Upserted(spark, f"{bronze}/{s.spec.source}").rows(), s.spec), f"{out}/{s.name}", s.day)
        save_table(_tags(rows, s), f"{out}/{s.tags_name}", s.day)
    _save_lookups(spark, out)
    for name, rows in _facts(spark, out, lambda s: open_table(spark, f"{out}/{s.name}")).items():
        save_table(rows, f"{out}/{name}", "date_key")
    _remember(spark, bronze, out)


def _values(df: DataFrame) -> set:
    """Distinct days; a few thousand at most."""
    return {r[0] for r in df.distinct().collect()}


def _changes(spark: SparkSession, bronze: str, out: str, s: Stream, seen: int) -> tuple[DataFrame, set]:
    """(clean rows of the days that batches after ``seen`` touch, these days)."""
    table = Upserted(spark, f"{bronze}/{s.spec.source}")
    # Keys are compared as the clean table has them: raw keys may differ in blanks only.
    fields = tuple(f for f in s.spec.fields if f.name in s.spec.key)
    keys = tidy(table.deltas().filter(F.col("batch_id") > seen), fields).select(*s.spec.key).distinct()
    named = [replace(f, name=f"_key_{f.name}", source=f.source or f.name).sql() for f in fields]
    raw, wanted = table.rows().selectExpr("*", *named), keys.toDF(*[f"_key_{c}" for c in keys.columns])
    new = clean(raw.join(wanted, wanted.columns, "left_semi").drop(*wanted.columns), s.spec)
    old = open_table(spark, f"{out}/{s.name}")
    days = _values(new.select(s.day)) | _values(old.join(keys, list(s.spec.key), "left_semi").select(s.day))
    kept = _of_days(old, s.day, days).join(keys, list(s.spec.key), "left_anti")
    return kept.unionByName(new).select(*old.columns), days


def _of_days(rows: DataFrame, day: str, days: set) -> DataFrame:
    return rows.filter(F.col(day).isin(*days) if days else F.lit(False))


def _days_of(spark: SparkSession, out: str, s: Stream, changed: DataFrame, without_campaign: bool) -> set:
    """Days that have a tuple of a changed campaign, or of none if that matters."""
    tags = open_table(spark, f"{out}/{s.tags_name}")
    days = _values(tags.join(changed, "campaign_id", "left_semi").select(s.day))
    return days | (_values(tags.filter("campaign_id IS NULL").select(s.day)) if without_campaign else set())


def refresh(spark: SparkSession, bronze: str, out: str) -> dict[str, list[int]]:
    """Follows the batches since the last build or refresh; returns the days written anew per fact. If bronze merged a batch that
    was not followed yet, its keys are no longer known and everything is built. A refresh that fails is made good by the
    next one: touched days are noted before anything is written, and facts are compared with the lookups they were made with."""
    state = state_of(spark, f"{out}/{REFRESHED}")
    seen = state.get("seen", {})
    if any(Upserted(spark, f"{bronze}/{s.spec.source}").state["merged"] > seen.get(s.name, -2) for s in (WEB, ADS)):
        build(spark, bronze, out)
        return {name: sorted(_values(open_table(spark, f"{out}/{name}").select("date_key"))) for name in FACTS}
    changes = {s: _changes(spark, bronze, out, s, seen[s.name]) for s in (WEB, ADS)}
    touched = {s: days | {date.fromisoformat(d) for d in state["pending"].get(s.name, ())} for s, (_, days) in changes.items()}
    pending = {s.name: sorted(d.isoformat() for d in days) for s, days in touched.items()}
    publish(spark, f"{out}/{REFRESHED}", state | {"pending": pending})
    for s, (rows, days) in changes.items():
        if days:
            written = replace_parts(rows, f"{out}/{s.name}", sorted(days))
            replace_parts(_tags(_of_days(written, s.day, days), s), f"{out}/{s.tags_name}", sorted(days))
    if any(touched.values()):
        _save_lookups(spark, out)
    used, now = open_table(spark, f"{out}/{USED}"), open_table(spark, f"{out}/dim_campaign").select(*LOOKUP)
    changed = used.exceptAll(now).unionAll(now.exceptAll(used)).select("campaign_id").distinct()
    turned = state["no_channel"] != _no_channel(open_table(spark, f"{out}/dim_channel"))
    days = {s: touched[s] | _days_of(spark, out, s, changed, s is WEB and turned) for s in (WEB, ADS)}
    made = _facts(spark, out, lambda s: _of_days(open_table(spark, f"{out}/{s.name}"), s.day, days[s]))
    written = {name: sorted(int(d.strftime("%Y%m%d")) for d in days[s]) for name, s in zip(FACTS, (ADS, WEB))}
    for name, parts in written.items():
        if parts:
            replace_parts(made[name], f"{out}/{name}", parts)
    _remember(spark, bronze, out)
    return written
