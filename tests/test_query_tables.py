import pytest

from tidemark.plans import query_tables as qt
from tidemark.sources.files import read_activity_csv

HEADER = ("artist,auth,firstName,gender,itemInSession,lastName,length,level,location,method,"
          "page,registration,sessionId,song,status,ts,userId\n")


def line(artist, item, session, song, user, first="Ada", length="495.3073"):
    return (f'{artist},Logged In,{first},F,{item},Park,{length},free,"Austin, TX",PUT,NextSong,'
            f"1.54E+12,{session},{song},200,1.54112E+12,{user}\n")


@pytest.fixture
def logs(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in/2018-11-01-events.csv").write_text(
        HEADER + line("Faithful", 4, 338, '"Echo (Mix, Long)"', 50)
        + line("", 5, 338, "", "", length="")
        + line("Down Home", 1, 182, "Second", 10) + line("Down Home", 0, 182, "First", 10))
    (tmp_path / "in/2018-11-02-events.csv").write_text(
        HEADER + line("Faithful", 0, 12, '"Echo (Mix, Long)"', 50, first="Later"))
    return read_activity_csv(spark, str(tmp_path / "in"))


def test_job(logs, tmp_path, rows):
    tables = qt.run(logs, str(tmp_path / "out"))
    found = qt.song_in_session(tables["song_by_session"], 338, 4).first()
    assert (found["artist_name"], found["song"]) == ("Faithful", "Echo (Mix, Long)")
    assert abs(found["duration"] - 495.3073) < 1e-4
    heard = qt.songs_of_user_session(tables["songs_by_user_session"], 10, 182).collect()
    assert [(r["item_in_session"], r["song"]) for r in heard] == [(0, "First"), (1, "Second")]
    # The key is (song, user): the later day's row replaced the earlier one,
    # although its session number is lower.
    assert rows(qt.users_of_song(tables["users_by_song"], "Echo (Mix, Long)")) == [
        ("Later", "Park")]
    assert tables["song_by_session"].count() == 4
    assert dict(tables["song_by_session"].dtypes)["duration"] == "float"
    text = "".join(p.read_text() for p in (tmp_path / "out/events_csv").glob("*.csv"))
    assert text.count("\n") == 4 + text.count('"artist","firstName"')
