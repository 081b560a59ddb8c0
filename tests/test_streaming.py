import gzip
import json
import os
import random
from pathlib import Path
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from tidemart.operators.latest import keep_latest
from tidemart.schemas import CSV_SOURCES
from tidemart.sources.files import files_below, read_csv, write_json
from tidemart.sources.headers import read_by_header
from tidemart.sources.published import open_table, replace_parts, save_table, state_of
from tidemart.sources.scratch import scratch_folder, scratch_removed
from tidemart.streaming.ingest import (
    ADS_KEYS,
    WEB_KEYS,
    batch_writer,
    bronze_reader,
    ingest_ads,
    ingest_csv_sources,
    ingest_web_events,
    read_appended,
)
from tidemart.streaming.upserts import Upserted, merge_deltas, read_upserts


@pytest.fixture
def folders(tmp_path):
    return tuple(str(tmp_path / n) for n in ("landing", "bronze", "checkpoints"))


def write(path: str, *lines: str) -> None:
    Path(path).parent.mkdir(parents=True, exist_ok=True)
    Path(path).write_text("\n".join(lines) + "\n")


def event(key, price, time="2024-01-01T10:00:00Z"):
    return json.dumps({"event_id": key, "event_time": time, "session_id": "s", "price_at_event": price})


def prices(df):
    return {r.event_id: r.price_at_event for r in df.collect()}


def test_csv_appends_only_new_files(spark, folders):
    landing, bronze, checkpoints = folders
    write(f"{landing}/sellers/a.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state", "s1,01001,X,SP")
    write(
        f"{landing}/category_translation/a.csv", "product_category_name,product_category_name_english", "casa,house"
    )
    names = ["sellers", "category_translation"]
    for files in (1, 1, 2):
        if files == 2:
            write(f"{landing}/sellers/run/b.csv", "seller_id,seller_zip_code_prefix,seller_city,seller_state", "s2,7,,RJ")
        ingest_csv_sources(spark, *folders, sources=names)
        rows = bronze_reader(spark, bronze)("bronze_sellers").collect()
        assert sorted(r.seller_id for r in rows) == [f"s{i + 1}" for i in range(files)]
    assert {r.seller_zip_code_prefix for r in rows} == {1001, 7}
    assert all(r.source_file.endswith(".csv") and r.ingestion_time for r in rows)
    assert bronze_reader(spark, bronze)("bronze_category_translation").count() == 1


def test_web_upsert(spark, folders):
    landing = folders[0]
    write(f"{landing}/web_events/run_1/a.json", event("e1", 1), event("e2", 2), event(None, 3), event("e2", 1), "{broken")
    assert prices(ingest_web_events(spark, *folders)) == {"e1": 1.0, "e2": 2.0}
    # Nothing new.
    assert prices(ingest_web_events(spark, *folders)) == {"e1": 1.0, "e2": 2.0}
    # A late row updates its key, in a new run folder.
    write(f"{landing}/web_events/run_2/a.json", event("e1", 9, "2020-01-01T00:00:00Z"), event("e3", 3, "yesterday"))
    web = ingest_web_events(spark, *folders)
    assert prices(web) == {"e1": 9.0, "e2": 2.0, "e3": 3.0}
    assert {r.event_id: r.event_time is None for r in web.collect()} == {"e1": False, "e2": False, "e3": True}
    assert dict(web.dtypes)["event_time"] == "timestamp" and "source_file" in web.columns
    assert prices(bronze_reader(spark, folders[1])("bronze_web_events")) == prices(web)


def test_replayed_batch_changes_nothing(spark, tmp_path):
    table = str(tmp_path / "table")
    writer = batch_writer(table, ["k"], buckets=4)
    batches = [[("a", 1), ("b", 1), (None, 5)], [("a", 2)]]
    for _ in range(2):
        for i, rows in enumerate(batches):
            writer(spark.createDataFrame(rows, "k string, v int").withColumn("ingestion_time", _now()), i)
    assert Upserted(spark, table).deltas().count() == 3
    assert values(read_upserts(spark, table)) == {"a": 2, "b": 1}
    merge_deltas(spark, table)
    assert Upserted(spark, table).state["deltas"] == {} and values(read_upserts(spark, table)) == {"a": 2, "b": 1}
    with pytest.raises(ValueError, match="merged already"):
        writer(spark.createDataFrame([("a", 1)], "k string, v int"), 1)
    writer(spark.createDataFrame([("a", 3), ("c", 3)], "k string, v int").withColumn("ingestion_time", _now()), 2)
    assert values(read_upserts(spark, table)) == {"a": 3, "b": 1, "c": 3}
    assert values(Upserted(spark, table).superseded()) == {"a": 2}


def values(df):
    return {r.k: r.v for r in df.collect()}


def test_upserts_follow_a_plain_merge(spark, tmp_path):
    """Many batches with merges in between, against a dictionary."""
    rng, want, table = random.Random(3), {}, str(tmp_path / "table")
    writer = batch_writer(table, ["k"], buckets=5)
    for batch in range(7):
        rows = {f"k{rng.randrange(60)}": rng.randrange(1000) for _ in range(25)}
        want |= rows
        writer(spark.createDataFrame(list(rows.items()), "k string, v int"), batch)
        if batch in (2, 4):
            merge_deltas(spark, table)
        assert values(read_upserts(spark, table)) == want
    before = {p: p.stat().st_mtime_ns for p in Path(table, "base").rglob("*.parquet")}
    writer(spark.createDataFrame([("k1", -1)], "k string, v int"), 9)
    merge_deltas(spark, table)
    bucket = spark.sql("SELECT pmod(xxhash64('k1'), 5) AS b").first()["b"]
    merge_deltas(spark, table)
    writer(spark.createDataFrame([("k1", -2)], "k string, v int"), 10)
    merge_deltas(spark, table)
    base = Upserted(spark, table).state["base"]
    assert len({v for b, v in base.items() if b != str(bucket)}) == 1 < len(set(base.values()))
    assert all(p.stat().st_mtime_ns == t for p, t in before.items() if p.exists())
    assert values(read_upserts(spark, table)) == want | {"k1": -2}


def test_reading_after_a_small_batch_shuffles_no_untouched_bucket(spark, tmp_path):
    table = str(tmp_path / "table")
    writer = batch_writer(table, ["k"], buckets=8)
    writer(spark.range(4000).selectExpr("CAST(id AS STRING) AS k", "CAST(id AS INT) AS v"), 0)
    merge_deltas(spark, table)
    assert "Exchange" not in plan_of(read_upserts(spark, table))
    writer(spark.createDataFrame([("17", -1)], "k string, v int"), 1)
    found = Upserted(spark, table)
    assert len(found.touched) == 1
    untouched, touched = found._base(touched=False), found._base(touched=True)
    buckets = [{r["bucket"] for r in df.select("bucket").distinct().collect()} for df in (touched, untouched)]
    assert buckets[0] == set(found.touched) and not buckets[0] & buckets[1]
    assert "PartitionFilters: [" in plan_of(touched) and "concat_ws" in plan_of(touched).split("PartitionFilters: [")[1].split("]")[0]
    plan = plan_of(found.rows())
    first = plan[plan.index("Union") :].split("Location")[0]  # the first input of the union is the untouched base
    assert "Exchange" not in first and "Scan parquet" in first
    assert values(found.rows())["17"] == -1 and found.rows().count() == 4000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _now():
    from pyspark.sql import functions as F

    return F.current_timestamp()


def test_ads_upsert(spark, folders):
    landing = folders[0]

    def ad(day, campaign, clicks):
        return json.dumps({"date": day, "campaign_id": campaign, "clicks": clicks, "impressions": 3_000_000_000})

    write(f"{landing}/api_ads_raw/r1/a.json", ad("2024-01-01", "c", 1), ad("2024-01-02", "c", 1), ad("soon", "c", 1))
    assert ingest_ads(spark, *folders).count() == 2
    write(f"{landing}/api_ads_raw/r2/a.json", ad("2024-01-01", "c", 5), ad("2024-01-01", None, 5))
    rows = {str(r.date): r for r in ingest_ads(spark, *folders).collect()}
    assert {d: r.clicks for d, r in rows.items()} == {"2024-01-01": 5, "2024-01-02": 1}
    assert {r.source_api for r in rows.values()} == {"ads_api"} and rows["2024-01-01"].impressions == 3_000_000_000


def test_upsert_keys():
    assert (WEB_KEYS, ADS_KEYS) == (("event_id",), ("date", "campaign_id"))


def test_batch_csv_and_json_files(spark, tmp_path):
    write(str(tmp_path / "in" / "a.csv"), "id,n,text", "x,1,hello", "y,2,")
    df = read_csv(spark, str(tmp_path / "in"), columns=["id", "n"])
    assert df.dtypes == [("id", "string"), ("n", "int")] and df.count() == 2
    rows = spark.range(1000).selectExpr("cast(id AS string) AS id", "'hot' AS campaign")
    write_json(rows, str(tmp_path / "json"), 4, "campaign", ["id"], 100)
    files = list((tmp_path / "json").glob("*.json"))
    lines = [len(f.read_text().splitlines()) for f in files]
    assert sum(lines) == 1000 and max(lines) <= 100
    tasks = {f.name.split("-")[1] for f in files}
    assert len(tasks) > 1  # one campaign is not one task


def session(master, **settings):
    return SimpleNamespace(conf=settings, sparkContext=SimpleNamespace(master=master))


def test_scratch_folder_follows_the_cluster_setting():
    cluster = session("yarn", **{"spark.checkpoint.dir": "hdfs:/shared/checkpoints/"})
    assert scratch_folder(cluster).startswith("hdfs:/shared/checkpoints/tidemart-")
    assert scratch_folder(cluster) != scratch_folder(cluster)
    assert Path(scratch_folder(session("local[8]"))).is_dir()
    for master in ("yarn", "local-cluster[2,1,1024]", "k8s://host"):
        with pytest.raises(ValueError):
            scratch_folder(session(master))


def test_later_run_wins_within_one_batch(spark, folders):
    """The file written last wins, whatever its run is called."""
    for age, run, price in ((3, "run_9", 9), (2, "run_10", 5), (1, "run_2", 1)):
        path = f"{folders[0]}/web_events/{run}/a.json"
        write(path, event("e1", price))
        os.utime(path, (1_700_000_000 - age,) * 2)
    assert prices(ingest_web_events(spark, *folders)) == {"e1": 1.0}


def test_ingest_merges_waiting_batches_by_itself(spark, folders):
    for run in range(10):
        write(f"{folders[0]}/web_events/run_{run}/a.json", event("e1", run), event(f"f{run}", run))
    web = ingest_web_events(spark, *folders, options={"maxFilesPerTrigger": "1"})
    found = Upserted(spark, f"{folders[1]}/bronze_web_events")
    assert found.state["deltas"] == {} and found.state["merged"] == 9
    assert prices(web) == {"e1": 9.0} | {f"f{i}": float(i) for i in range(10)}


def test_nothing_landed_gives_empty_tables(spark, folders):
    Path(folders[0], "web_events").mkdir(parents=True)
    assert ingest_web_events(spark, *folders).count() == 0
    assert bronze_reader(spark, folders[1])("bronze_sellers").columns[0] == "seller_id"


def test_done_files_can_be_moved_away(spark, folders, tmp_path):
    """A landing folder does not grow for ever: what earlier batches took is archived, and the result is that of one batch."""
    archive = str(tmp_path / "archive")
    options = {"maxFilesPerTrigger": "1", "cleanSource": "archive", "sourceArchiveDir": archive}
    for run in range(4):
        write(f"{folders[0]}/web_events/run_{run}/a.json", event("e1", run), event(f"f{run}", run))
        write(f"{folders[0]}/sellers/run_{run}/a.csv", "seller_id,seller_zip_code_prefix", f"s{run},{run}")
    web = ingest_web_events(spark, *folders, options=options)
    ingest_csv_sources(spark, *folders, sources=["sellers"], options=options)
    once = tuple(str(tmp_path / "once" / n) for n in ("bronze", "checkpoints"))
    for path in Path(archive).rglob("*.json"):
        write(str(tmp_path / "again" / path.name) + path.parent.name, path.read_text())
    assert prices(web) == {"e1": 3.0} | {f"f{i}": float(i) for i in range(4)}
    assert {r.seller_id for r in bronze_reader(spark, folders[1])("bronze_sellers").collect()} == {f"s{i}" for i in range(4)}
    assert len(list(Path(archive).rglob("a.json"))) >= 3 and len(list(Path(archive).rglob("a.csv"))) >= 3
    left = len(list(Path(folders[0]).rglob("a.*")))
    assert left <= 2 and once


def test_bounded_batches_and_unreadable_lines(spark, folders):
    for run in range(4):
        write(f"{folders[0]}/web_events/run_{run}/a.json", event("e1", run), "{broken")
    web = ingest_web_events(spark, *folders, options={"maxFilesPerTrigger": "1"})
    assert prices(web) == {"e1": 3.0}
    log = Upserted(spark, f"{folders[1]}/bronze_web_events").deltas()
    assert log.select("batch_id").distinct().count() == 4
    bad = spark.read.parquet(f"{folders[1]}/bronze_web_events_unreadable")
    assert [r["_corrupt_record"] for r in bad.collect()] == ["{broken"] * 4


def test_csv_goes_by_header_names(spark, folders, tmp_path, caplog):
    schema = "id string, n int, city string"
    write(str(tmp_path / "in" / "a.csv"), "city,new,id,n", "X,?,s1,01001")
    df = read_csv(spark, str(tmp_path / "in"), schema)
    assert df.columns == ["id", "n", "city"] and [tuple(r) for r in df.collect()] == [("s1", 1001, "X")]
    assert "new column new" in caplog.text
    write(str(tmp_path / "less" / "a.csv"), "n,id", "5,s1")
    assert [tuple(r) for r in read_csv(spark, str(tmp_path / "less"), schema).collect()] == [("s1", 5, None)]
    write(f"{folders[0]}/sellers/a.csv", "seller_state,seller_id,seller_zip_code_prefix,seller_city", "SP,s1,7,X", "SP,s2,x7,Y")
    ingest_csv_sources(spark, *folders, sources=["sellers"])
    kept = bronze_reader(spark, folders[1])("bronze_sellers").collect()
    assert [(r.seller_id, r.seller_zip_code_prefix, r.seller_city, r.seller_state) for r in kept] == [("s1", 7, "X", "SP")]
    assert spark.read.parquet(f"{folders[1]}/bronze_sellers").count() == 2  # the unreadable row keeps its text


def test_scratch_is_removed(spark):
    kept = Path(scratch_folder(spark).removeprefix("file:"))
    with scratch_removed(spark):
        folder = scratch_folder(spark)
        spark.range(3).write.parquet(f"{folder}/t")
        assert Path(folder.removeprefix("file:"), "t").is_dir()
    assert not Path(folder.removeprefix("file:")).exists()
    spark.range(3).write.parquet(f"{kept}/t")
    assert kept.exists()


def test_every_file_goes_by_its_own_header(spark, tmp_path, folders, caplog):
    schema = "id string, n int"
    write(str(tmp_path / "in" / "a.csv"), "id,n", "s1,1")
    write(str(tmp_path / "in" / "b.csv"), "", " N ,id,more", "2,s2,x", "x2,s3,y")
    write(str(tmp_path / "in" / "c[1] {x}.csv"), '"id"', '"s,4"')
    Path(tmp_path / "in" / "empty.csv").write_text("")
    with gzip.open(tmp_path / "in" / "d.csv.gz", "wt") as f:
        f.write("\ufeffn,n,id\n5,6,s5\n")
    got = read_csv(spark, str(tmp_path / "in"), schema).collect()
    assert sorted((r.id, r.n) for r in got) == [("s,4", None), ("s1", 1), ("s2", 2), ("s3", None), ("s5", 5)]
    assert "new column more" in caplog.text and read_csv(spark, str(tmp_path / "none"), schema).count() == 0
    rows, extras = read_by_header(spark, files_below(spark, str(tmp_path / "in")), schema, known=["old"])
    assert extras == ["old", "more", "n_1"] and {r.more for r in rows.collect()} == {"x", "y", None}


def test_schema_grows_over_starts(spark, folders):
    header = "seller_id,seller_zip_code_prefix,seller_city,seller_state"
    for text in ([header, "s1,1,X,SP"], ["note,seller_state,seller_id", "hello,RJ,s2"], [header + ",_rescued_data,second", "s3,3,Y,SP,?,2"]):
        write(f"{folders[0]}/sellers/{len(text[0])}.csv", *text)
        ingest_csv_sources(spark, *folders, sources=["sellers"])
    rows = bronze_reader(spark, folders[1])("bronze_sellers")
    assert rows.columns == [*header.split(","), "note", "second", "ingestion_time", "source_file"]
    assert sorted((r.seller_id, r.seller_state, r.note, r.second) for r in rows.collect()) == [("s1", "SP", None, None), ("s2", "RJ", "hello", None), ("s3", "SP", None, "2")]
    table = f"{folders[1]}/bronze_sellers"
    assert state_of(spark, table) == {"batches": [0, 1, 2], "extras": ["note", "second"]}
    assert read_appended(spark, table, CSV_SOURCES["sellers"]).count() == 3


def test_readers_see_whole_tables_only(spark, tmp_path):
    """A rewrite that fails half-way leaves the table as it was, also for who has it open."""
    table = str(tmp_path / "t")
    opened = save_table(spark.range(10).selectExpr("id", "id % 2 AS part"), table)
    failing = spark.range(100).selectExpr("id", "IF(id > 90, raise_error('lost'), 0L) AS part").repartition(8)
    with pytest.raises(Exception, match="lost"):
        save_table(failing, table)
    assert opened.count() == open_table(spark, table).count() == 10
    Path(table, "_published", "000000000077.json").write_text('{"version": ')  # a writer that died
    assert open_table(spark, table).count() == 10
    later = save_table(spark.range(20).selectExpr("id", "id % 2 AS part"), table)
    assert later.count() == 20 and opened.count() == 10  # the state before is kept for its readers
    save_table(spark.range(30).selectExpr("id", "id % 2 AS part"), table)
    assert open_table(spark, table).count() == 30 and len(list(Path(table).glob("version=*"))) == 2


def test_parts_are_replaced_alone(spark, tmp_path):
    table = str(tmp_path / "t")
    days = spark.sql("SELECT id, date_add(DATE'2024-01-01', CAST(id % 4 AS INT)) AS day FROM range(40)")
    save_table(days, table, "day")
    files = {p: p.stat().st_mtime_ns for p in Path(table).rglob("*.parquet")}
    changed = days.filter("day = '2024-01-02'").withColumn("id", F.col("id") + 1000)
    got = replace_parts(changed, table, ["2024-01-02", "2024-01-04"])
    want = days.filter("day IN ('2024-01-01', '2024-01-03')").unionByName(changed)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.dtypes == days.dtypes
    assert all(p.stat().st_mtime_ns == t for p, t in files.items())
    with pytest.raises(ValueError, match="not to be replaced"):
        replace_parts(days, table, ["2024-01-02"])
    assert open_table(spark, table).count() == 30
    with pytest.raises(FileNotFoundError):
        open_table(spark, str(tmp_path / "none"))


def test_latest_of_log_needs_no_order(spark):
    rows = [("a", i, i % 3) for i in range(30)]
    df = spark.createDataFrame(rows, "k string, batch_id int, v int").repartition(5)
    assert keep_latest(df, ["k"], newest=("batch_id",)).first()["v"] == 29 % 3


def test_waiting_rows_without_a_base_are_sorted_once(spark, tmp_path):
    """Reading a table whose base has none of the touched buckets joins nothing."""
    table = str(tmp_path / "t")
    rows = spark.createDataFrame([("a", 1), ("b", 2)], "event_id string, price int")
    batch_writer(table, ["event_id"], 4)(rows, 0)
    batch_writer(table, ["event_id"], 4)(rows.selectExpr("event_id", "price + 10 AS price").filter("event_id = 'b'"), 1)
    found = read_upserts(spark, table)
    assert "Join" not in found._jdf.queryExecution().optimizedPlan().toString()
    assert sorted(map(tuple, found.collect())) == [("a", 1), ("b", 12)]
    Upserted(spark, table).merge()
    batch_writer(table, ["event_id"], 4)(spark.createDataFrame([("a", 5)], "event_id string, price int"), 2)
    assert sorted(map(tuple, read_upserts(spark, table).collect())) == [("a", 5), ("b", 12)]


def test_landed_json_is_packed(spark, folders):
    """Small on disk, and read as before."""
    from tidemart.streaming.landing import land_web

    other = ("TIMESTAMP '2024-01-01 00:00:00' AS event_time", "CAST(id AS double) AS price_at_event", "'c' AS campaign_id")
    rows = spark.range(2000).selectExpr("CAST(id AS string) AS event_id", *other)
    land_web(rows, folders[0], "run_1")
    files = list(Path(folders[0], "web_events", "run_1").glob("part-*"))
    assert sum(f.stat().st_size for f in files) < 2000 * 40 and all(f.name.endswith(".json.gz") for f in files)
    assert prices(ingest_web_events(spark, *folders)) == {str(i): float(i) for i in range(2000)}
