"""Domain inputs drawn from the general-purpose tables.

The formulas below only spread table values over realistic ranges. They are
written in the SQL subset that Spark and the checking database share, so both
sides of a comparison start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citysignal import schemas
from citysignal.functions import decision, keys, sentiment
from citysignal.operators import traffic
from citysignal.plans import archive
from citysignal.session import configure
from citysignal.sources.envelopes import envelopes, spread

AS_OF = "2024-01-31 00:00:00"
DAY = "1 day"
HOUR = "1 hour"
EPOCH_2024 = 1704067200  # 2024-01-01 00:00:00 UTC
FORECAST_HOURS = 720
POLL_HOURS = 3

# --- Input formulas: plain arithmetic, valid in both SQL dialects -------------
# events: e = event_id, u = user_id
LAT = "52 + (e * 7919 % 1000) / 2000"
LON = "208 / 10 + (e * 104729 % 1000) / 2000"
COMPOUND = "(e * 37 % 201) / 100 - 1"
DECISION = {
    "traffic_score": "(e * 37 % 101) / 100",
    "weather_score": "(e * 53 % 101) / 100",
    "sentiment_score": "(e * 71 % 101) / 100",
}

# orders: k = o_orderkey, j = position in the poll
POLL_HOUR = f"(k * 7 + j) % {FORECAST_HOURS}"
WEATHER = {
    "temp_2m": "((k * 37 + j * 11) % 500) / 10 - 12",
    "apparent_temp": "((k * 61 + j * 11) % 500) / 10 - 14",
    "precip_probability": "CAST((k * 13 + j) % 101 AS INT)",
    "precip_total": "((k * 17 + j * 5) % 300) / 20",
    "rain": "((k * 19 + j * 7) % 300) / 20",
    "snowfall": "((k * 23 + j) % 9) / 100",
    "snow_depth": "((k * 29 + j * 3) % 45) / 100",
    "weather_code": "CAST((k * 31 + j) % 100 AS INT)",
    "cloud_cover": "CAST((k * 41 + j) % 101 AS INT)",
    "relative_humidity": "CAST((k * 43 + j) % 101 AS INT)",
    "wind_speed": "((k * 47 + j * 13) % 600) / 10",
    "wind_gusts": "((k * 47 + j * 13) % 600) / 10 * 3 / 2",
}
AIR = {
    column: f"((k * {53 + 2 * i} + j * {i + 1}) % 900) / 10"
    for i, column in enumerate(schemas.AIR_QUALITY.columns)
}

# lineitem: adding zero turns a negative zero into a plain one
LINE_WEATHER = {
    "apparent_temp": "l_quantity - 12",
    "rain": "l_discount * 150 + 0",
    "snowfall": "l_tax + 0",
    "snow_depth": "l_discount * 4 + 0",
    "wind_speed": "l_quantity * 12 / 10",
    "weather_code": "CAST(l_partkey % 100 AS INT)",
    "hour": "CAST(l_orderkey % 24 AS INT)",
}

# documents: d = doc_id
POST = {
    "lat": "52 + (d * 7919 % 1000) / 2000",
    "lon": "208 / 10 + (d * 104729 % 1000) / 2000",
    "like_count": "d * 13 % 500",
    "retweet_count": "d * 29 % 200",
    "reply_count": "n_chars % 50",
    "view_count": "d * 1000003",
}
POST_AGE_SECONDS = "d * 7919 % 172800"

# Common words of the documents' languages with a valence, (word, valence).
LEXICON = (
    ("the", 0.4),
    ("of", -0.7),
    ("and", 0.3),
    ("to", 0.1),
    ("in", -0.2),
    ("that", -1.1),
    ("was", -0.6),
    ("with", 0.9),
    ("de", 0.5),
    ("la", -0.4),
    ("der", -0.8),
    ("und", 0.6),
)
KEYWORDS = ("from", "und", "les", "que la")
DISTRICTS = 18
# -----------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return from_events(table(spark, sf_dir, "events"))


def from_events(rows: DataFrame) -> DataFrame:
    """Works on a batch or a streaming read of the events table."""
    return rows.select(
        F.col("event_id").alias("e"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.col("user_id").alias("u"),
        "event_type",
        "value",
    )


def positions_of(rows: DataFrame) -> DataFrame:
    placed = rows.withColumns({"lat": F.expr(LAT), "lon": F.expr(LON)}).withColumn(
        "vn", F.col("u").cast("string")
    )
    return traffic.positions(placed, vehicle="vn", ts="ts", seq="e")


def positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vehicle positions: one per event."""
    return positions_of(events(spark, sf_dir))


def moods_of(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("e").cast("string").alias("tweet_id"), "ts", F.expr(COMPOUND).alias("compound")
    ).withColumn("sentiment_score", sentiment.bucket(F.col("compound")))


def moods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored messages: one per event."""
    return moods_of(events(spark, sf_dir))


def decisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions: one per event; a few share their second, and with it their id."""
    scored = events(spark, sf_dir).withColumns({c: F.expr(x) for c, x in DECISION.items()})
    blended = scored.withColumn(
        "global_score",
        decision.global_score(
            F.col("traffic_score"), F.col("weather_score"), F.col("sentiment_score")
        ),
    ).withColumn("decision_result", decision.result(F.col("global_score")))
    vehicles = F.transform(
        F.sequence(F.lit(0), F.pmod("u", F.lit(4)).cast("int")),
        lambda i: (F.col("u") + i).cast("string"),
    )
    targets = F.when(F.col("decision_result") == "SHOW_AD", vehicles).otherwise(
        F.array().cast("array<string>")
    )
    second = F.date_trunc("second", "ts")
    return blended.select(
        keys.second_key(F.col("ts")).alias("decision_id"),
        "traffic_score",
        "weather_score",
        "sentiment_score",
        "global_score",
        "decision_result",
        decision.campaign(F.col("decision_result"), targets).alias("campaign_type"),
        targets.alias("targets"),
        second.alias("decision_time"),
        decision.display_time(second).alias("display_time"),
        F.col("e").alias("seq"),
        F.col("u").alias("user_id"),
    )


def archive_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decisions in archive shape, without going through storage."""
    return archive.archive_rows(decisions(spark, sf_dir))


def polls_of(rows: DataFrame) -> DataFrame:
    return rows.select(
        F.col("o_orderkey").alias("k"),
        F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("priority"),
    )


def polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forecast polls: one per order, each covering a few consecutive hours."""
    return polls_of(table(spark, sf_dir, "orders"))


def _hour_of(formula: str = POLL_HOUR):
    return F.timestamp_seconds(F.lit(EPOCH_2024) + F.expr(formula) * 3600)


def forecast(spark: SparkSession, sf_dir: str, formulas: dict[str, str] = WEATHER) -> DataFrame:
    """Forecast rows with repeated hours; the highest ``seq`` of an hour is current."""
    return forecast_of(polls(spark, sf_dir), formulas)


def forecast_of(polled: DataFrame, formulas: dict[str, str] = WEATHER) -> DataFrame:
    hours = polled.withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(POLL_HOURS - 1))))
    return hours.select(
        keys.hour_key(_hour_of()).alias("row_key"),
        _hour_of().alias("ts"),
        *[F.expr(formula).alias(column) for column, formula in formulas.items()],
        F.col("k").alias("seq"),
    )


def hourly_messages(
    spark: SparkSession, sf_dir: str, feed: schemas.HourlyFeed, formulas: dict[str, str]
) -> DataFrame:
    """The polls as JSON messages of parallel arrays.

    Some lack a measure, some have one that is too short, some name an
    unreadable hour.
    """

    def at(formula: str, j: int):
        return F.expr(formula.replace("j", str(j)))

    def series(formula: str):
        return [at(formula, j) for j in range(POLL_HOURS)]

    times = [
        F.date_format(
            F.timestamp_seconds(F.lit(EPOCH_2024) + at(POLL_HOUR, j) * 3600), keys.FORECAST_TIME
        )
        for j in range(POLL_HOURS)
    ]
    times[-1] = F.when(F.col("priority") == "5-LOW", F.lit("pending")).otherwise(times[-1])
    arrays = [F.array(*times).alias("time")]
    for number, (field, column, _) in enumerate(feed.measures):
        values = series(formulas[column])
        array = F.array(*values)
        if number == 1:
            array = F.when(F.col("status") != "P", array)
        if number == 6:
            array = F.when(F.col("status") == "O", F.array(*values[:-1])).otherwise(array)
        arrays.append(array.alias(field))
    body = F.to_json(F.struct(F.struct(*arrays).alias("hourly")))
    raw = spread(polls(spark, sf_dir)).select(
        body.alias("value"),
        F.timestamp_seconds(F.lit(EPOCH_2024) + F.col("k")).alias("timestamp"),
    )
    return envelopes(raw)


def line_weather(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weather readings: one per order line."""
    return table(spark, sf_dir, "lineitem").select(
        F.lit(None).cast("double").alias("temp_2m"),
        *[F.expr(formula).alias(column) for column, formula in LINE_WEATHER.items()],
    )


def vehicle_records(rows: DataFrame) -> DataFrame:
    """Vehicle messages as Kafka-like records, one per event.

    Errors carry no list, sign-ups an empty one, and purchases vehicles with
    gaps. Works on a streaming read too.
    """
    purchase = F.col("event_type") == "purchase"

    def vehicle(j: int):
        e = f"(e + {j})"
        number = (F.col("u") + j).cast("string")
        lat = F.expr(LAT.replace("e *", f"{e} *"))
        return F.struct(
            (100 + F.col("u") % 40).cast("string").alias("Lines"),
            F.expr(LON.replace("e *", f"{e} *")).alias("Lon"),
            (F.when(~purchase, number) if j == 1 else number).alias("VehicleNumber"),
            F.date_format(F.col("ts") + F.expr(f"INTERVAL {j} SECONDS"), keys.CLOCK_TIME).alias(
                "Time"
            ),
            (F.when(~purchase, lat) if j == 2 else lat).alias("Lat"),
            F.lpad((F.col("e") % 100).cast("string"), 3, "0").alias("Brigade"),
        )

    listed = F.to_json(F.struct(F.array(*[vehicle(j) for j in range(3)]).alias("result")))
    body = (
        F.when(F.col("event_type") == "error", F.lit('{"result":"service unavailable"}'))
        .when(F.col("event_type") == "signup", F.lit('{"result":[]}'))
        .otherwise(listed)
    )
    return rows.select(body.alias("value"), F.col("ts").alias("timestamp"))


def vehicle_messages(spark: SparkSession, sf_dir: str, trolleys: bool | None = None) -> DataFrame:
    rows = spread(events(spark, sf_dir))
    if trolleys is not None:
        is_trolley = F.col("event_type") == "view"
        rows = rows.filter(is_trolley if trolleys else ~is_trolley)
    return envelopes(vehicle_records(rows))


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages with text: one per document, texts whole."""
    return posts_of(spread(table(spark, sf_dir, "documents")))


def posts_of(documents: DataFrame) -> DataFrame:
    """Works on a batch or a streaming read of the documents table."""
    rows = documents.select(F.col("doc_id").alias("d"), "text", "lang", "source", "n_chars")
    age = F.expr(POST_AGE_SECONDS)
    return rows.select(
        F.col("d").cast("string").alias("tweet_id"),
        F.timestamp_seconds(F.unix_timestamp(F.lit(AS_OF).cast("timestamp")) - age).alias("ts"),
        "text",
        "lang",
        "source",
        *[F.expr(formula).alias(column) for column, formula in POST.items()],
    )


EDITED_AFTER = "1 hour"


def with_edits(posted: DataFrame) -> DataFrame:
    """The posts and, for those in French, a second delivery with the first half of the text."""
    first = F.struct(F.col("ts"), F.col("text"))
    later = F.struct(
        (F.col("ts") + F.expr(f"INTERVAL {EDITED_AFTER}")).alias("ts"),
        F.left("text", F.floor(F.char_length("text") / 2).cast("int")).alias("text"),
    )
    both = F.when(F.col("lang") == "fr", F.array(first, later)).otherwise(F.array(first))
    rest = [name for name in posted.columns if name not in ("ts", "text")]
    return posted.select(*rest, F.inline(both))


def tweet_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tweet_messages_of(posts(spark, sf_dir))


def tweet_messages_of(posted: DataFrame) -> DataFrame:
    """The posts as JSON messages of the current API version."""
    tags = (
        F.when(F.col("lang") == "de", F.array().cast("array<struct<text:string>>"))
        .when(F.col("lang") == "es", F.lit(None))
        .otherwise(F.array(F.struct(F.col("lang").alias("text")), F.struct(F.col("source").alias("text"))))
    )
    post = F.struct(
        F.col("tweet_id").alias("id"),
        F.col("text"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("createdAt"),
        F.struct(
            F.col("source").alias("userName"),
            F.when(F.col("lang") != "fr", F.upper("source")).alias("name"),
            F.col("tweet_id").alias("id"),
        ).alias("author"),
        F.struct(tags.alias("hashtags")).alias("entities"),
        F.col("lang"),
        F.col("like_count").alias("likeCount"),
        F.col("retweet_count").alias("retweetCount"),
        F.col("reply_count").alias("replyCount"),
        F.col("view_count").alias("viewCount"),
    )
    return posted.select(
        F.to_json(F.struct(F.array(post).alias("tweets"))).alias("json"),
        F.col("ts").alias("kafka_ts"),
    )


def mixed_tweet_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The posts as messages whose field names vary with the language."""
    lang = F.col("lang")
    old = lang == "de"
    created = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    author = F.when(
        lang.isin("en", "fr"),
        F.struct(
            F.col("source").alias("userName"),
            F.when(lang == "fr", F.lit("")).otherwise(F.upper("source")).alias("name"),
        ),
    )
    user = F.when(old, F.struct(F.col("source").alias("screen_name")))
    tags = F.array(
        F.struct(lang.alias("text")), F.struct(F.lit("").alias("text")), F.struct(F.col("source").alias("text"))
    )
    post = F.struct(
        F.when(~old, F.col("tweet_id")).alias("id"),
        F.when(old, F.col("tweet_id")).alias("id_str"),
        F.when(old, F.lit("")).otherwise(F.col("text")).alias("text"),
        F.when(old, F.col("text")).alias("full_text"),
        F.when(~old, created).alias("createdAt"),
        F.when(old, created).alias("created_at"),
        author.alias("author"),
        user.alias("user"),
        F.struct(F.when(lang != "es", tags).alias("hashtags")).alias("entities"),
    )
    return posts(spark, sf_dir).select(
        F.to_json(F.struct(F.array(post).alias("tweets"))).alias("json"),
        F.col("ts").alias("kafka_ts"),
    )


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEXICON), "word STRING, valence DOUBLE")
