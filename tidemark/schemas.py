"""Declared tables: column types, widths, keys and domains."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class Field:
    name: str
    dtype: str
    width: int | None = None          # text is cut to this many characters
    required: bool = False            # NOT NULL
    allowed: tuple[str, ...] = ()     # enum domain
    epoch_millis: bool = False        # a timestamp that arrives as epoch milliseconds
    source: str | None = None         # dotted path in the raw record, if not ``name``


@dataclass(frozen=True)
class Table:
    name: str
    fields: tuple[Field, ...]
    key: tuple[str, ...] = ()                                     # primary key
    references: dict[str, str] = field(default_factory=dict)      # column -> table.column
    sort: tuple[str, ...] = ()                                    # sort key of the layout
    distribution: tuple[str, ...] = ()                            # bucket key of the layout

    @property
    def names(self) -> list[str]:
        return [f.name for f in self.fields]

    @property
    def ddl(self) -> str:
        return ", ".join(f"`{f.name}` {f.dtype}" for f in self.fields)

    @property
    def struct(self) -> StructType:
        return StructType.fromDDL(self.ddl)


def _table(name: str, columns: str, width: int | None = None, **rest) -> Table:
    """``columns`` are declared as in SQL: ``name type [NOT NULL]``, parted by a comma and a blank."""
    fields = []
    for entry in columns.split(", "):
        column, dtype, *required = entry.split()
        fields.append(Field(column, dtype, width if dtype == "string" else None, bool(required)))
    return Table(name, tuple(fields), **rest)


# ---- activity logs and songs -------------------------------------------------
# Names and types of the fields in the files.

LOG_JSON = (
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length double, level string, location string, method string, "
    "page string, registration double, sessionId int, song string, status int, ts bigint, "
    "userAgent string, userId string"
)
SONG_JSON = (
    "num_songs int, artist_id string, artist_latitude double, artist_longitude double, "
    "artist_location string, artist_name string, song_id string, title string, "
    "duration double, year int"
)
LOG_CSV = (
    "artist string, auth string, firstName string, gender string, itemInSession int, "
    "lastName string, length double, level string, location string, method string, "
    "page string, registration double, sessionId int, song string, status int, ts string, "
    "userId string"
)

_TEXT = 256

#: Staged logs with event time, as the warehouse variant loads them.
STAGED_LOGS = Table("stage_events", tuple(
    Field("ts", "timestamp", epoch_millis=True) if f.name == "ts" else f
    for f in _table(
        "", "artist string, auth string, firstName string, gender string, itemInSession int, "
        "lastName string, length double, level string, location string, method string, page string, "
        "registration bigint, sessionId int, song string, status int, ts bigint, userAgent string, "
        "userId int", _TEXT).fields
))
STAGED_SONGS = _table(
    "stage_songs", "song_id string, num_songs int, title string, artist_name string, "
    "artist_latitude double, year int, duration double, artist_id string, "
    "artist_longitude double, artist_location string", _TEXT, key=("song_id",))

#: Staged logs and songs of the pipeline variant: whole-number decimals, raw epoch.
ROUNDED_LOGS = _table(
    "staging_events", "artist string, auth string, firstName string, gender string, "
    "itemInSession int, lastName string, length decimal(18,0), level string, location string, "
    "method string, page string, registration decimal(18,0), sessionId int, song string, status int, "
    "ts bigint, userAgent string, userId int", _TEXT)
ROUNDED_SONGS = _table(
    "staging_songs", "num_songs int, artist_id string, artist_name string, "
    "artist_latitude decimal(18,0), artist_longitude decimal(18,0), artist_location string, "
    "song_id string, title string, duration decimal(18,0), year int", _TEXT)

# ---- star schema -------------------------------------------------------------
# Names and types of the output tables' columns.

_CALENDAR = "start_time timestamp NOT NULL, hour int, day int, week int, month int, year int, weekday int"

WAREHOUSE = {t.name: t for t in (
    _table("users", "user_id int NOT NULL, first_name string, last_name string, gender string, level string",
           key=("user_id",), sort=("user_id",)),
    _table("songs", "song_id string NOT NULL, title string, artist_id string, year int, duration double",
           key=("song_id",), sort=("song_id",)),
    _table("artists", "artist_id string NOT NULL, name string, location string, latitude double, "
           "longitude double", key=("artist_id",), sort=("artist_id",)),
    _table("time", _CALENDAR, key=("start_time",), sort=("start_time",),
           distribution=("start_time",)),
    _table("songplays", "songplay_id bigint NOT NULL, start_time timestamp, user_id int, level string, "
           "song_id string, artist_id string, session_id int, location string, user_agent string",
           key=("songplay_id",), sort=("start_time",), distribution=("start_time",),
           references={"user_id": "users.user_id", "song_id": "songs.song_id",
                       "artist_id": "artists.artist_id"}),
)}

PIPELINE = {t.name: t for t in (
    _table("users", "user_id int NOT NULL, first_name string, last_name string, gender string, level string",
           key=("user_id",)),
    _table("songs", "song_id string NOT NULL, title string, artist_id string, year int, "
           "duration decimal(18,0)", key=("song_id",)),
    _table("artists", "artist_id string NOT NULL, name string, location string, latitude decimal(18,0), "
           "longitude decimal(18,0)"),
    _table("time", _CALENDAR, key=("start_time",)),
    _table("songplays", "songplay_id string NOT NULL, start_time timestamp NOT NULL, user_id int NOT NULL, level string, "
           "song_id string, artist_id string, session_id int, location string, user_agent string",
           key=("songplay_id",)),
)}

LAKE = {t.name: t for t in (
    _table("users", "user_id string, first_name string, last_name string, gender string, "
           "level string"),
    _table("songs", "song_id string, title string, artist_id string, year int, duration double"),
    _table("artists", "artist_id string, artist_name string, artist_location string, "
           "artist_latitude double, artist_longitude double"),
    _table("time", "start_time timestamp, hour int, day int, week int, month int, year int, "
           "weekday int"),
    _table("songplays", "songplay_id bigint, start_time timestamp, month int, year int, "
           "user_id string, level string, song_id string, artist_id string, session_id int, "
           "location string, user_agent string"),
)}

# ---- messages ----------------------------------------------------------------
# Names and types of the fields in the messages.

ENVELOPE = (
    "key binary, value binary, topic string, partition int, offset bigint, "
    "timestamp timestamp, timestampType int"
)

CALL = (
    "client_id string, original_crime_type_name string, report_date timestamp, "
    "call_date timestamp, offense_date timestamp, call_time string, call_date_time timestamp, "
    "disposition string, address string, city string, state string, agency_id string, "
    "address_type string, common_location string"
)
CODE = "disposition_code string, description string"

SORTED_SET = (
    "key string, value string, expiredType string, expiredValue string, existType string, "
    "ch string, incr boolean, zSetEntries array<struct<element:string,score:string>>"
)
CUSTOMER = "customerName string, email string, phone string, birthDay string"
RISK = "customer string, score float, riskDate date"

STOP = (
    "stop_id int, direction_id string, stop_name string, station_name string, "
    "station_descriptive_name string, station_id int, `order` int, red boolean, blue boolean, "
    "green boolean"
)
#: A stop as the source database declares it.
STOPS = _table(
    "stations", "stop_id int NOT NULL, direction_id string NOT NULL, stop_name string NOT NULL, station_name string NOT NULL, "
    "station_descriptive_name string NOT NULL, station_id int NOT NULL, order int, red boolean NOT NULL, blue boolean NOT NULL, "
    "green boolean NOT NULL", key=("stop_id",))
MESSAGE_KEY = "timestamp bigint"
ARRIVAL = (
    "station_id int, train_id string, direction string, line string, train_status string, "
    "prev_station_id int, prev_direction string"
)
TURNSTILE = "station_id int, station_name string, line string"
WEATHER = "temperature int, status string"

# Weather and train states a message may carry.
WEATHER_STATES = ("sunny", "partly_cloudy", "cloudy", "windy", "precipitation")
TRAIN_STATES = ("out_of_service", "in_service", "broken_down")

SEED = (
    "station_id int, stationame string, month_beginning string, avg_weekday_rides double, "
    "avg_saturday_rides double, `avg_sunday-holiday_rides` double, monthtotal bigint"
)
CURVE = "hour int, ridership_ratio double"
