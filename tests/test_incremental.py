"""Tables that follow late rows, against a full build."""

import json
from pathlib import Path

import pytest

from tidemart.plans import incremental
from tidemart.sources.published import open_table, state_of
from tidemart.streaming.ingest import ingest_ads, ingest_web_events
from tidemart.streaming.upserts import merge_deltas

TABLES = ("silver_web_events", "silver_ads_campaigns", "bridge_campaign_mapping", "dim_campaign", "dim_channel", *incremental.FACTS)


@pytest.fixture
def store(spark, tmp_path):
    class Store:
        bronze, out = str(tmp_path / "bronze"), str(tmp_path / "out")
        runs = 0

        def land(self, events=(), ads=()):
            self.runs += 1
            for kind, rows in (("web_events", events), ("api_ads_raw", ads)):
                path = tmp_path / "landing" / kind / f"run_{self.runs}" / "a.json"
                path.parent.mkdir(parents=True)
                path.write_text("".join(json.dumps(r) + "\n" for r in rows))
            for ingest in (ingest_web_events, ingest_ads):
                ingest(spark, str(tmp_path / "landing"), self.bronze, str(tmp_path / "checkpoints"))

        def rows(self, name, out=""):
            df = open_table(spark, f"{out or self.out}/{name}")
            return sorted(map(str, df.drop("silver_processed_at", "ingestion_time").select(*sorted(c for c in df.columns if c not in ("silver_processed_at", "ingestion_time"))).collect()))

        def check(self):
            incremental.build(spark, self.bronze, full := f"{self.out}-full-{self.runs}")
            for name in TABLES:
                assert self.rows(name) == self.rows(name, full), name

        def files(self, name):
            return {p: p.stat().st_mtime_ns for p in Path(self.out, name).rglob("*.parquet")}

    return Store()


def event(key, day, campaign, kind="view_product", session="s", **more):
    return {"event_id": key, "event_time": f"2024-01-{day:02d}T10:00:00Z", "session_id": session, "event_type": kind, "campaign_id": campaign, "device": "web", **more}


def ad(day, campaign, clicks=1, source="google"):
    return {"date": f"2024-01-{day:02d}", "campaign_id": campaign, "campaign_name": "n", "channel": "paid", "source": source, "medium": "cpc", "impressions": 10, "clicks": clicks, "conversions": 0, "cost": 2.0, "currency": "BRL"}


def test_refresh_equals_a_full_build_and_touches_only_its_days(spark, store):
    store.land([event(f"e{d}{i}", d, "c1" if i else None, session=f"s{i}") for d in range(1, 6) for i in range(3)], [ad(d, "c1") for d in range(1, 6)])
    incremental.build(spark, store.bronze, store.out)
    before = {n: store.files(n) for n in TABLES}
    # A changed row, a row that moves to another day, a new row under a key with blanks, and one day of ads.
    store.land([event("e11", 1, "c1", "add_to_cart"), event("e21", 3, "c1"), event(" e32 ", 3, "c1", session="other")], [ad(4, "c1", 5)])
    days = incremental.refresh(spark, store.bronze, store.out)
    assert days == {"fact_marketing_spend_daily": [20240104], "fact_web_funnel_daily": [20240101, 20240102, 20240103]}
    store.check()
    for name, parts in (("fact_web_funnel_daily", days["fact_web_funnel_daily"]), ("fact_marketing_spend_daily", [20240104])):
        new = {p.parent.name for p in set(store.files(name)) - set(before[name])}
        assert new == {f"date_key={d}" for d in parts}
        assert all(p.stat().st_mtime_ns == t for p, t in before[name].items() if p.exists())
    assert incremental.refresh(spark, store.bronze, store.out) == {n: [] for n in incremental.FACTS}


def test_refresh_follows_changed_campaigns_to_other_days(spark, store):
    store.land([event("a", 1, "c1"), event("b", 2, "c2"), event("c", 3, None)], [ad(1, "c1"), ad(2, "c3")])
    incremental.build(spark, store.bronze, store.out)
    # The ads of day 5 change source and so the channel of c1, whose event lies on day 1; c3 gets its first event.
    store.land([event("d", 6, "c3")], [ad(5, "c1", source="bing")])
    days = incremental.refresh(spark, store.bronze, store.out)
    assert {20240101, 20240106} <= set(days["fact_web_funnel_daily"]) and 20240102 not in days["fact_web_funnel_daily"]
    # A row that becomes invalid leaves; its tuple goes with it. Events without campaign get a channel of their own.
    store.land([event("b", 2, "c2", "no such type"), event("x", 4, "c9", utm_source="unknown", utm_medium="unknown")])
    incremental.refresh(spark, store.bronze, store.out)
    store.check()


def test_refresh_after_a_failure_and_after_an_unfollowed_merge(spark, store, monkeypatch):
    store.land([event("a", 1, "c1"), event("b", 2, "c1")], [ad(1, "c1")])
    incremental.build(spark, store.bronze, store.out)
    store.land([event("a", 3, "c1")])
    with monkeypatch.context() as broken:
        broken.setattr(incremental, "_facts", lambda *_: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            incremental.refresh(spark, store.bronze, store.out)
    assert state_of(spark, f"{store.out}/refreshed")["pending"]["silver_web_events"] == ["2024-01-01", "2024-01-03"]
    assert incremental.refresh(spark, store.bronze, store.out)["fact_web_funnel_daily"] == [20240101, 20240103]
    store.land([event("b", 4, "c2")])
    merge_deltas(spark, f"{store.bronze}/bronze_web_events")
    days = incremental.refresh(spark, store.bronze, store.out)
    assert days["fact_web_funnel_daily"] == [20240103, 20240104]
    store.check()
