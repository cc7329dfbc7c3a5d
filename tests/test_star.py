"""The star schema on a small fixture, variant by variant."""

import datetime as dt
import hashlib

import pytest

from tidemark import schemas
from tidemark.operators.quality import QualityError
from tidemark.plans import star

TS = 1543092353796


def log(**changes):
    base = dict(artist="Blue Tram", auth="Logged In", firstName="Ada", gender="F",
                itemInSession=1, lastName="Park", length=205.26975, level="free",
                location="Lubbock, TX", method="PUT", page="NextSong",
                registration=1540708070796.0, sessionId=867, song="Night Bus", status=200, ts=TS,
                userAgent="Agent/1", userId="83")
    return {**base, **changes}


def song(**changes):
    base = dict(num_songs=1, artist_id="AR1", artist_latitude=None, artist_longitude=-97.5,
                artist_location="", artist_name="Blue Tram", song_id="SO1", title="Night Bus",
                duration=205.4, year=0)
    return {**base, **changes}


def frame(spark, records, ddl):
    schema = spark.createDataFrame([], ddl).schema
    return spark.createDataFrame([tuple(r[f.name] for f in schema) for r in records], schema)


@pytest.fixture(scope="module")
def data(spark):
    logs = frame(spark, [
        log(),
        log(),                                                     # the same play again
        log(itemInSession=2, level="paid", ts=TS + 5000),          # the user changed level
        log(itemInSession=3, artist="Unknown", song="Lost", ts=TS + 9000),
        log(itemInSession=4, artist=None, song=None, length=None, page="Home", ts=TS + 12000),
        log(userId="", artist=None, song=None, length=None, page="Login", firstName=None,
            lastName=None, gender=None, ts=TS + 15000),
        log(userId="7", firstName="Bo", lastName="Lee", gender="M", length=300.0,
            ts=TS + 20000, location="  "),
    ], schemas.LOG_JSON)
    songs = frame(spark, [
        song(),
        song(song_id="SO2", duration=300.4, artist_location="Texas", year=1999),
    ], schemas.SONG_JSON)
    return logs, songs


def second(offset=0):
    return dt.datetime(2018, 11, 24, 20, 45, 53) + dt.timedelta(seconds=offset)


def test_warehouse(data, rows):
    t = star.build(*data, "warehouse")
    # The join has no length, so both songs match every play; equal rows collapse.
    assert t["songplays"].count() == 6
    keys = [r["songplay_id"] for r in t["songplays"].collect()]
    assert sorted(keys) == list(range(6))
    starts = {r["start_time"] for r in t["songplays"].collect()}
    assert starts == {second(), second(5), second(20)}
    assert rows(t["users"]) == sorted([
        (7, "Bo", "Lee", "M", "free"), (83, "Ada", "Park", "F", "free"),
        (83, "Ada", "Park", "F", "paid")], key=repr)
    assert rows(t["artists"]) == sorted([
        ("AR1", "Blue Tram", None, None, -97.5), ("AR1", "Blue Tram", "Texas", None, -97.5)],
        key=repr)
    times = t["time"].collect()
    assert len(times) == 6                       # every page, once per moment
    assert {r["weekday"] for r in times} == {6}  # Saturday, Sunday = 0
    assert second().replace(microsecond=796000) in {r["start_time"] for r in times}


def test_lake(data):
    t = star.build(*data, "lake")
    assert t["songplays"].count() == 8           # duplicates kept
    assert t["songplays"].select("songplay_id").distinct().count() == 8
    assert t["users"].count() == 5 and t["time"].count() == 5
    assert {r["weekday"] for r in t["time"].collect()} == {7}
    assert {r["artist_location"] for r in t["artists"].collect()} == {"", "Texas"}
    row = t["songplays"].filter("user_id = '7'").first()
    assert (row["year"], row["month"]) == (2018, 11)
    assert row["location"] == "  "


def test_pipeline(data, rows):
    t = star.build(*data, "pipeline")
    plays = t["songplays"].collect()
    assert len(plays) == 5                       # a left join: unknown songs stay
    by_start = {(r["user_id"], r["start_time"]): r["song_id"] for r in plays}
    assert by_start[(83, second())] == "SO1"     # 205.26975 and 205.4 round alike
    assert by_start[(7, second(20))] == "SO2"
    assert by_start[(83, second(9))] is None
    key = hashlib.md5(b"8672018-11-24 20:45:53").hexdigest()
    assert [r["songplay_id"] for r in plays].count(key) == 2    # not unique
    assert t["time"].count() == 5                # one row per fact row
    assert rows(t["songs"], "song_id", "duration") == [("SO1", 205), ("SO2", 300)]
    assert t["artists"].filter("longitude = -98").count() == 2
    assert [r["location"] for r in plays if r["user_id"] == 7] == [None]


def test_latest_dedup(data, rows):
    from dataclasses import replace
    t = star.build(*data, replace(star.VARIANTS["warehouse"], dedup="latest"))
    assert rows(t["users"], "user_id", "level") == [(7, "free"), (83, "free")]
    assert rows(t["artists"], "artist_id", "location") == [("AR1", "Texas")]
    assert t["songs"].count() == 2


def test_views(spark, data):
    star.as_views(star.build(*data, "lake", ("users",)), "lake_")
    assert spark.sql("SELECT * FROM lake_users WHERE level = 'paid'").count() == 1


def test_run_lake(spark, data, tmp_path):
    paths = star.run_lake(*data, str(tmp_path / "lake"))
    assert spark.read.parquet(paths["songplays"]).count() == 8
    assert (tmp_path / "lake/songplays/year=2018/month=11").is_dir()
    assert (tmp_path / "lake/songs/year=1999").is_dir()
    star.run_lake(*data, str(tmp_path / "lake"))                 # replaces, not appends
    assert spark.read.parquet(paths["songplays"]).count() == 8


@pytest.mark.parametrize("variant", ["warehouse", "pipeline"])
def test_run_pipeline_from_files(spark, data, tmp_path, variant):
    import datetime
    from tidemark.__main__ import main
    logs, songs = data
    logs.write.json(str(tmp_path / "2018/11/24/log_data/a/b"))
    songs.write.json(str(tmp_path / "song_data/A/B/C"))
    database = f"files_{variant}"
    star.run_pipeline(spark, str(tmp_path), database, variant, datetime.date(2018, 11, 24))
    want = star.build(logs, songs, variant)
    for name in ("users", "songs", "artists", "time"):
        assert spark.table(f"{database}.{name}").count() == want[name].count()
    assert spark.table(f"{database}.songplays").drop("songplay_id").exceptAll(
        want["songplays"].drop("songplay_id")).count() == 0
    # The same through the command line, replacing what is there.
    main(["load", "--root", str(tmp_path), "--database", database, "--variant", variant,
          "--run-date", "2018-11-24"])
    assert spark.table(f"{database}.songplays").count() == want["songplays"].count()


def test_staging_formats(spark, tmp_path):
    (tmp_path / "songs").mkdir()
    (tmp_path / "songs/s.csv").write_text("a,b\n1,x\n2,\n")
    spec = schemas.Table("csv_stage", (schemas.Field("n", "int"), schemas.Field("t", "string")))
    rows = star.stage_table(spark, spec, "fmt", str(tmp_path), "songs", file_format="CSV")
    assert sorted(tuple(r) for r in rows.collect()) == [(1, "x"), (2, None)]
    with pytest.raises(ValueError):
        star.stage_table(spark, spec, "fmt", str(tmp_path), "songs", file_format="xml")


def test_run_warehouse_and_gate(spark, data):
    checks = (["SELECT count(*) FROM wh.users WHERE user_id IS NULL"], [0])
    star.run_warehouse(spark, *data, "wh", checks=checks)
    star.run_warehouse(spark, *data, "wh", checks=checks)
    assert spark.table("wh.songplays").count() == 6
    star.run_warehouse(spark, *data, "wh", truncate=False)       # append: keys go on
    keys = sorted(r[0] for r in spark.table("wh.songplays").select("songplay_id").collect())
    assert keys == list(range(12))
    star.run_warehouse(spark, *data, "pl", variant="pipeline")
    assert spark.table("pl.time").count() == 5
    with pytest.raises(QualityError):
        star.run_warehouse(spark, *data, "wh", checks=(["SELECT count(*) FROM wh.users"], [0]))
