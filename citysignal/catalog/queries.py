"""The registered queries: each operator applied to the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citysignal import config as C
from citysignal import schemas
from citysignal.catalog import views as V
from citysignal.functions import decision, geo, keys, sentiment, text
from citysignal.operators import cells, combine, parse, search, state, store, traffic, weather
from citysignal.operators import sentiment as mood
from citysignal.plans import archive, feeds, partials, reports
from citysignal.plans.decisions import decide_windows, decision_plan
from citysignal.session import configure, scratch
from citysignal.sinks import layers, publish
from citysignal.sources import envelopes, samples, scans
from citysignal.streaming import ingest, windows

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

RANGE = ("20240110_060000", "20240120_183000")
POINT = "20240115_10"
ARCHIVE_DAY = "20240115"
ARCHIVE_HOUR = "14"
INGESTED = "2024-01-31 00:00:00"
ROUND = 6
AVERAGE_ROUND = 9


def query(name: str) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        return function

    return register


def rounded(*names: str) -> list:
    return [F.round(F.col(name), ROUND).alias(name) for name in names]


def averaged(*names: str) -> list:
    """Means need more places: their seventh is often an exact five, and summing
    order would decide which way it rounds."""
    return [F.round(F.col(name), AVERAGE_ROUND).alias(name) for name in names]


def window_key(part: str = "start"):
    return keys.second_key(F.col(f"window.{part}")).alias(f"window_{part}")


def clock(name: str):
    return F.date_format(name, keys.CLOCK_TIME).alias(name)


# --- Sources ------------------------------------------------------------------


@query("src_envelopes")
def src_envelopes(spark, sf_dir):
    topic = scratch(spark, "topic")
    V.vehicle_records(V.events(spark, sf_dir)).write.parquet(topic)
    messages = envelopes.read_envelopes(spark, topic, format="parquet")
    out = scratch(spark, "messages")
    windows.run_to_files(messages, out, scratch(spark, "checkpoint"))
    return spark.read.parquet(out).select(
        "json", F.date_format("kafka_ts", keys.CLOCK_TIME).alias("kafka_ts")
    )


@query("scan_key_range")
def scan_key_range(spark, sf_dir):
    stored = archive.read(spark, _archive_path(spark, sf_dir))
    rows = scans.scan_range(stored, *RANGE, key="decision_id")
    return rows.select("decision_id", "decision_result", *rounded("global_score"))


@query("get_by_key")
def get_by_key(spark, sf_dir):
    return _stored(spark, sf_dir, "forecast", V.forecast, "row_key").get(POINT).select(
        "row_key", *rounded("temp_2m", "wind_speed"), "weather_code", "seq"
    )


@query("scan_limit")
def scan_limit(spark, sf_dir):
    return _stored(spark, sf_dir, "decisions", V.decisions, "decision_id").head(5).select(
        "decision_id", "decision_result", *rounded("global_score")
    )


_TABLES: dict[tuple[str, str, str], store.KeyedTable] = {}


def _stored(spark, sf_dir, name, rows, key) -> store.KeyedTable:
    """A keyed table, written once per session and input."""
    configure(spark)
    place = (spark.sparkContext.applicationId, sf_dir, name)
    if place not in _TABLES:
        table = store.KeyedTable(spark, scratch(spark, name), key, ["seq"])
        table.upsert(rows(spark, sf_dir), 0)
        _TABLES[place] = table
    return _TABLES[place]


@query("load_recent")
def load_recent(spark, sf_dir):
    stored = archive.read(spark, _archive_path(spark, sf_dir)).withColumns(
        {score: F.col(score).cast("string") for score in schemas.SCORES}
    )
    return scans.load_recent(stored, V.AS_OF, "36 hours").select(
        "decision_id",
        *rounded(*schemas.SCORES),
        "decision_result",
        "target_locations",
        "decision_time",
        "display_time",
    )


@query("sample_decisions")
def sample_decisions(spark, sf_dir):
    return samples.sample_decisions_for(V.events(spark, sf_dir), "e").select(
        "decision_id", *rounded(*schemas.SCORES), "decision_result", "decision_time"
    )


# --- Archive ------------------------------------------------------------------

_ARCHIVES: dict[tuple[str, str], str] = {}


def _archive_path(spark: SparkSession, sf_dir: str) -> str:
    """Archive of all decisions, written once per session and input."""
    configure(spark)
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _ARCHIVES:
        path = scratch(spark, "archive")
        archive.archive_increment(spark, V.decisions(spark, sf_dir), path, "20240201_000000")
        _ARCHIVES[place] = path
    return _ARCHIVES[place]


def _archive_table(spark: SparkSession, sf_dir: str) -> str:
    path = _archive_path(spark, sf_dir)
    name = f"decisions_{path.rsplit('-', 1)[-1]}"
    archive.create_table(spark, name, path)
    archive.refresh_partitions(spark, name)
    return name


ARCHIVE_OUT = ("decision_id", "decision_result", "target_locations", "display_time", "dt", "hr")


@query("archive_roundtrip")
def archive_roundtrip(spark, sf_dir):
    rows = archive.read(spark, _archive_path(spark, sf_dir))
    return rows.select(*ARCHIVE_OUT, *rounded(*schemas.SCORES))


@query("archive_by_day")
def archive_by_day(spark, sf_dir):
    rows = archive.by_day(archive.read(spark, _archive_path(spark, sf_dir)), ARCHIVE_DAY)
    return rows.select(*ARCHIVE_OUT, *rounded("global_score"))


@query("archive_by_hour")
def archive_by_hour(spark, sf_dir):
    rows = spark.table(_archive_table(spark, sf_dir))
    return archive.by_hour(rows, ARCHIVE_DAY, ARCHIVE_HOUR).select(
        *ARCHIVE_OUT, *rounded("global_score")
    )


@query("archive_describe")
def archive_describe(spark, sf_dir):
    """Columns of the archive table and how many of its rows fill each."""
    name = _archive_table(spark, sf_dir)
    filled = reports.dataset_overview(spark.table(name)).select("column_name", "n_filled")
    columns = archive.describe(spark, name).withColumnRenamed("col_name", "column_name")
    return columns.join(filled, "column_name")


@query("archive_partitions")
def archive_partitions(spark, sf_dir):
    return archive.partitions(spark, _archive_table(spark, sf_dir))


@query("archive_campaigns")
def archive_campaigns(spark, sf_dir):
    """The view's rows beside the campaigns that only the table keeps."""
    table = _archive_table(spark, sf_dir)
    archive.create_view(spark, f"{table}_view", table)
    shown = spark.table(f"{table}_view").filter(F.col("dt") == ARCHIVE_DAY)
    campaigns = spark.table(table).filter(F.col("dt") == ARCHIVE_DAY)
    return shown.join(campaigns.select("decision_id", "campaign_type"), "decision_id").select(
        "decision_id", "decision_result", "target_locations", "campaign_type", "dt", "hr"
    )


@query("archive_incremental")
def archive_incremental(spark, sf_dir):
    """Three runs, the middle one repeated as after a timeout."""
    path = scratch(spark, "archive-inc")
    rows = V.decisions(spark, sf_dir)
    archive.archive_increment(spark, rows, path, "20240110_000000")
    # A run that wrote its rows but never got to move the mark.
    lost = scans.scan_range(rows, "20240110_000000", "20240119_123456", key="decision_id")
    latest = store.latest_per_key(lost, "decision_id", ["seq"])
    start = archive.high_water_mark(spark, f"{path}/_marks")
    archive.append(archive.archive_rows(latest, campaign=True), path, start, hours=240)
    archive.archive_increment(spark, rows, path, "20240120_123456")
    archive.archive_increment(spark, rows, path, "20240201_000000")
    return archive.read(spark, path).select(
        "decision_id", "decision_result", "dt", "hr", *rounded("global_score")
    )


@query("archive_reconciled")
def archive_reconciled(spark, sf_dir):
    """Decisions that come behind the mark, and others that were archived in another state, are mended."""
    path = scratch(spark, "archive-rec")
    rows = V.decisions(spark, sf_dir)
    late = F.pmod("seq", F.lit(10)) == 3
    wrong = F.pmod("seq", F.lit(50)) == 7
    known = rows.filter(~late).withColumn(
        "global_score", F.when(wrong, F.lit(0.0)).otherwise(F.col("global_score"))
    )
    archive.archive_increment(spark, known, path, "20240115_000000")
    archive.archive_increment(spark, known, path, "20240201_000000")
    archive.reconcile(spark, rows, path)
    return archive.read(spark, path).select(
        "decision_id", "decision_result", "dt", "hr", *rounded("global_score")
    )


# --- Stores and sinks ---------------------------------------------------------


@query("upsert_latest")
def upsert_latest(spark, sf_dir):
    table = store.KeyedTable(spark, scratch(spark, "decisions"), "decision_id", ["seq"])
    table.upsert(V.decisions(spark, sf_dir), 0)
    return table.latest().select("decision_id", "seq", "decision_result", *rounded("global_score"))


@query("compact_latest")
def compact_latest(spark, sf_dir):
    """Three writes: the first half is compacted, then everything, the rest stays logged."""
    table = store.KeyedTable(spark, scratch(spark, "forecast"), "row_key", ["seq"])
    rows = V.forecast(spark, sf_dir)
    early = F.col("ts") < F.lit("2024-01-16").cast("timestamp")
    table.upsert(rows.filter(early), 0)
    table = table.compact_into(scratch(spark, "forecast"))
    table.upsert(rows.filter(~early), 1)
    table = table.compact_into(scratch(spark, "forecast"))
    table.upsert(rows, 2)
    return table.latest().select("row_key", "seq", *rounded("temp_2m", "rain"))


@query("forecast_latest")
def forecast_latest(spark, sf_dir):
    current = store.latest_per_key(V.forecast(spark, sf_dir), "row_key", ["seq"])
    return current.select(
        "row_key", "seq", *rounded("temp_2m", "rain", "wind_gusts"), "cloud_cover"
    )


@query("retention_filter")
def retention_filter(spark, sf_dir):
    """Rows each feed would still hold at the same instant."""
    day = keys.key_date(F.col("decision_id")).alias("dt")
    made = V.decisions(spark, sf_dir).select("decision_id", F.col("decision_time").alias("ts"), day)
    feeds = {
        "vehicles": V.positions(spark, sf_dir).select(F.col("seq").cast("string").alias("id"), "ts"),
        "tweets": V.posts(spark, sf_dir).select(F.col("tweet_id").alias("id"), "ts"),
        "weather": V.forecast(spark, sf_dir).select(F.col("row_key").alias("id"), "ts"),
    }
    kept = store.retained(made, "decisions", V.AS_OF, partition="dt").select(
        F.lit("decisions").alias("feed"), F.col("decision_id").alias("id")
    )
    for feed, rows in feeds.items():
        kept = kept.unionByName(
            store.retained(rows, feed, V.AS_OF).select(F.lit(feed).alias("feed"), "id")
        )
    return kept


@query("publish_payload")
def publish_payload(spark, sf_dir):
    path = scratch(spark, "published")
    publish.publish(V.decisions(spark, sf_dir), path, format="json")
    sent = spark.read.schema("key STRING, value STRING").json(path)
    body = F.from_json("value", schemas.DECISION_PAYLOAD_JSON)
    return sent.select("key", body.alias("b")).select(
        "key",
        F.col("b.decision_id").alias("decision_id"),
        F.col("b.timestamp").alias("timestamp"),
        F.col("b.display_time").alias("display_time"),
        F.col("b.decision").alias("decision"),
        F.round("b.metrics.global", ROUND).alias("global"),
        F.round("b.metrics.traffic", ROUND).alias("traffic"),
        F.col("b.action.show_ad").alias("show_ad"),
        F.col("b.action.campaign").alias("campaign"),
        F.array_join("b.action.targets", "|").alias("targets"),
    )


@query("csv_roundtrip")
def csv_roundtrip(spark, sf_dir):
    path = scratch(spark, "csv")
    rows = V.archive_view(spark, sf_dir).drop("dt", "hr")
    layers.export_csv(rows, path)
    return layers.import_csv(spark, path, rows.schema).select(
        "decision_id",
        *rounded(*schemas.SCORES),
        "decision_result",
        "target_locations",
        "decision_time",
        "display_time",
    )


@query("batch_layer_vehicles")
def batch_layer_vehicles(spark, sf_dir):
    rows = parse.parse_vehicles(V.vehicle_messages(spark, sf_dir), "bus", ingested_at=INGESTED)
    day = F.substring("gps_time", 1, 10)
    path = layers.write_layer(layers.vehicles_layer(rows, day), scratch(spark, "layer"), "vehicles")
    read = spark.read.orc(path).withColumn("date", F.col("date").cast("string"))
    return read.select("date", "timestamp_utc", "linia", "pojazd_id", "lat", "lon")


@query("batch_layer_weather")
def batch_layer_weather(spark, sf_dir):
    messages = V.hourly_messages(spark, sf_dir, schemas.WEATHER, V.WEATHER)
    rows, _ = parse.quarantine_keyed(parse.parse_hourly(messages, schemas.WEATHER))
    layer = layers.weather_layer(rows, F.date_format("kafka_ts", "yyyy-MM-dd"))
    path = layers.write_layer(layer, scratch(spark, "layer"), "weather", "csv")
    read = (
        spark.read.schema(f"{_ddl(layer)}, date STRING")
        .option("header", True)
        .option("escape", '"')
        .csv(path)
    )
    return read.select(
        "date", "timestamp_godzinowy", "lat", "lon", "temperatura_2m", "deszcz", "zachmurzenie"
    )


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema.fields)


@query("batch_layer_tweets")
def batch_layer_tweets(spark, sf_dir):
    rows = parse.parse_tweets(V.tweet_messages(spark, sf_dir), ingested_at=INGESTED)
    judged = mood.bucketed(mood.score_rows(rows, V.lexicon(spark)))
    layer = layers.tweets_layer(judged, F.col("data_acquisition_date"))
    path = layers.write_layer(layer, scratch(spark, "layer"), "tweets")
    read = spark.read.orc(path).withColumn("date", F.col("date").cast("string"))
    return read.select("date", "tweet_id", "created_at", "author_name", "text", "sentiment", "hashtags")


# --- Parsing and keys ---------------------------------------------------------


@query("parse_vehicles")
def parse_vehicles(spark, sf_dir):
    rows = parse.parse_vehicles(V.vehicle_messages(spark, sf_dir), "bus", ingested_at=INGESTED)
    return rows.withColumn("ingestion_timestamp", clock("ingestion_timestamp"))


@query("union_feeds")
def union_feeds(spark, sf_dir):
    buses = parse.parse_vehicles(V.vehicle_messages(spark, sf_dir, trolleys=False), "bus")
    trolleys = parse.parse_vehicles(V.vehicle_messages(spark, sf_dir, trolleys=True), "trolley")
    return parse.union_feeds(buses, trolleys).select(
        "row_key", "vehicle_number", "vehicle_type", "lat", "lon"
    )


@query("parse_weather")
def parse_weather(spark, sf_dir):
    messages = V.hourly_messages(spark, sf_dir, schemas.WEATHER, V.WEATHER)
    rows = parse.parse_hourly(messages, schemas.WEATHER, ingested_at=INGESTED)
    return rows.select("row_key", *schemas.WEATHER.columns, "forecast_time")


@query("parse_air_quality")
def parse_air_quality(spark, sf_dir):
    messages = V.hourly_messages(spark, sf_dir, schemas.AIR_QUALITY, V.AIR)
    rows = parse.parse_hourly(messages, schemas.AIR_QUALITY, ingested_at=INGESTED)
    return rows.select("row_key", *schemas.AIR_QUALITY.columns, "forecast_time")


@query("zip_hourly")
def zip_hourly(spark, sf_dir):
    messages = V.hourly_messages(spark, sf_dir, schemas.WEATHER, V.WEATHER)
    return parse.zip_hourly(messages, schemas.WEATHER).select(
        "hour.time", "hour.temperature_2m", "hour.apparent_temperature", "hour.snow_depth"
    )


@query("parse_tweets")
def parse_tweets(spark, sf_dir):
    return parse.parse_tweets(V.tweet_messages(spark, sf_dir), ingested_at=INGESTED)


@query("hashtag_join")
def hashtag_join(spark, sf_dir):
    rows = parse.parse_tweets(V.tweet_messages(spark, sf_dir), ingested_at=INGESTED)
    return rows.select("tweet_id", "hashtags")


@query("tweet_normalize")
def tweet_normalize(spark, sf_dir):
    return parse.normalize_tweets(V.mixed_tweet_messages(spark, sf_dir), acquired_on=INGESTED)


@query("key_vehicle")
def key_vehicle(spark, sf_dir):
    number = F.when(F.col("event_type") != "error", F.col("u").cast("string"))
    return V.events(spark, sf_dir).select("e", keys.vehicle_key(F.col("ts"), number).alias("row_key"))


@query("key_tweet")
def key_tweet(spark, sf_dir):
    number = F.when(F.col("event_type") != "error", F.col("e").cast("string"))
    return V.events(spark, sf_dir).select("e", keys.tweet_key(F.col("ts"), number).alias("row_key"))


@query("key_hour")
def key_hour(spark, sf_dir):
    messages = V.hourly_messages(spark, sf_dir, schemas.WEATHER, V.WEATHER)
    return parse.zip_hourly(messages, schemas.WEATHER).select(
        "hour.time", keys.forecast_key(F.col("hour.time")).alias("row_key")
    )


@query("key_parse")
def key_parse(spark, sf_dir):
    """Keys back to timestamps; keys that do not start with a time are skipped."""
    key = F.when(F.col("event_type") == "error", F.concat_ws("_", F.lit("sensor"), "u")).otherwise(
        keys.vehicle_key(F.col("ts"), F.col("u").cast("string"))
    )
    rows = V.events(spark, sf_dir).select("e", key.alias("row_key"))
    return (
        rows.withColumn("key_time", keys.key_timestamp(F.col("row_key")))
        .filter(F.col("key_time").isNotNull())
        .select("e", "row_key", clock("key_time"))
    )


@query("key_partitions")
def key_partitions(spark, sf_dir):
    return archive.with_partitions(V.decisions(spark, sf_dir)).select("decision_id", "dt", "hr")


@query("default_fill")
def default_fill(spark, sf_dir):
    """Decisions as a store of strings would hold them, with gaps and junk."""
    rows = V.archive_view(spark, sf_dir)
    shown = F.col("decision_result") == C.SHOW_AD
    late = F.col("hr") >= "12"
    stored = rows.select(
        "decision_id",
        F.when(shown, F.col("traffic_score").cast("string")).alias("traffic_score"),
        F.when(late, F.col("weather_score").cast("string")).otherwise("None").alias("weather_score"),
        F.when(late, F.lit("")).otherwise(F.col("sentiment_score").cast("string")).alias("sentiment_score"),
        F.col("global_score").cast("string").alias("global_score"),
        F.when(shown, F.col("decision_result")).alias("decision_result"),
        F.when(shown, F.col("target_locations")).alias("target_locations"),
        F.when(late, F.col("decision_time")).alias("decision_time"),
        F.when(~late, F.col("display_time")).alias("display_time"),
    )
    return scans.with_defaults(stored).select(
        "decision_id",
        *rounded(*schemas.SCORES),
        "decision_result",
        "target_locations",
        "decision_time",
        "display_time",
    )


@query("quarantine_rows")
def quarantine_rows(spark, sf_dir):
    rows = parse.judged_vehicles(V.vehicle_messages(spark, sf_dir), "bus")
    arrived = F.date_format("kafka_ts", keys.CLOCK_TIME)
    return rows.select(
        F.coalesce("reason", F.lit("accepted")).alias("reason"),
        F.when(F.col("json").isNotNull(), arrived).otherwise(F.col("row_key")).alias("detail"),
    )


# --- Search -------------------------------------------------------------------


@query("filter_keywords")
def filter_keywords(spark, sf_dir):
    return search.with_keywords(V.posts(spark, sf_dir), V.KEYWORDS).select("tweet_id", "lang")


def _keyword_table(spark, sf_dir) -> DataFrame:
    """Words and phrases from the benchmark's texts: the first word, words 2-3, words 4-6."""
    words = sentiment.words(F.col("text"))
    cut = [F.array_join(F.slice(words, start, size), " ") for start, size in ((1, 1), (2, 2), (4, 3))]
    listed = V.table(spark, sf_dir, "benchmark").select(F.explode(F.array(*cut)).alias("keyword"))
    return listed.filter("keyword <> ''").distinct()


@query("filter_keyword_table")
def filter_keyword_table(spark, sf_dir):
    posts = V.posts(spark, sf_dir)
    found = search.with_keyword_table(posts, _keyword_table(spark, sf_dir))
    return found.select("tweet_id", "lang", F.array_join("keywords", "|").alias("keywords"))


@query("filter_geo_cells")
def filter_geo_cells(spark, sf_dir):
    """The radius over positions that are stored in the order of their cells."""
    path = scratch(spark, "cells")
    cells.write(V.positions(spark, sf_dir), path)
    return cells.within_radius(spark.read.parquet(path)).select("seq", "vn", "lat", "lon")


@query("filter_geo_radius")
def filter_geo_radius(spark, sf_dir):
    near = search.within_radius(V.positions(spark, sf_dir))
    return near.select("seq", "vn", "lat", "lon")


@query("filter_since")
def filter_since(spark, sf_dir):
    return search.since(V.posts(spark, sf_dir), V.AS_OF).select("tweet_id", clock("ts"))


def _search(spark, sf_dir, order):
    found = search.search(
        V.posts(spark, sf_dir),
        order=order,
        keywords=V.KEYWORDS,
        centre=C.SEARCH_CENTRE,
        as_of=V.AS_OF,
    )
    return found.select("tweet_id", clock("ts"), "text", "engagement")


@query("search_latest")
def search_latest(spark, sf_dir):
    return _search(spark, sf_dir, "latest")


@query("search_top")
def search_top(spark, sf_dir):
    return _search(spark, sf_dir, "top")


# --- Scalar functions ---------------------------------------------------------


@query("haversine")
def haversine(spark, sf_dir):
    lat, lon = C.SEARCH_CENTRE
    km = geo.haversine_km(F.lit(lat), F.lit(lon), F.col("lat"), F.col("lon"))
    return V.positions(spark, sf_dir).select("seq", F.round(km, ROUND).alias("km"))


@query("weather_factors")
def weather_factors(spark, sf_dir):
    names = ("temperature", "precipitation", "snow", "depth", "wind", "code")
    points = [f"{name}_points" for name in names]
    rows = weather.factors(V.line_weather(spark, sf_dir))
    return rows.select("apparent_temp", "rain", "wind_speed", "weather_code", *points)


@query("weather_score")
def weather_score(spark, sf_dir):
    rows = weather.scores(V.line_weather(spark, sf_dir), F.col("hour"))
    return rows.select("apparent_temp", "hour", "weather_code", *rounded("weather_score"))


@query("weather_explain")
def weather_explain(spark, sf_dir):
    rows = weather.explained(V.line_weather(spark, sf_dir), F.col("hour"))
    return rows.select("apparent_temp", "hour", "factors_used")


@query("sentiment_bucket")
def sentiment_bucket(spark, sf_dir):
    bucket = sentiment.bucket(F.col("compound"))
    return V.moods(spark, sf_dir).select("tweet_id", *rounded("compound"), bucket.alias("bucket"))


@query("lexicon_sentiment")
def lexicon_sentiment(spark, sf_dir):
    scored = mood.score_rows(V.posts(spark, sf_dir), V.lexicon(spark))
    return mood.bucketed(scored).select(
        "tweet_id", "matches", F.round("valence", 4).alias("valence"), F.round("compound", 4).alias("compound")
    )


@query("global_score")
def global_score(spark, sf_dir):
    """Both named blends side by side."""
    parts = [F.col(c) for c in ("traffic_score", "weather_score", "sentiment_score")]
    documented = decision.global_score(*parts, C.DOCUMENTED)
    return V.decisions(spark, sf_dir).select(
        "seq",
        F.round(decision.global_score(*parts), ROUND).alias("global_score"),
        F.round(documented, ROUND).alias("documented_score"),
        decision.result(F.round(documented, ROUND), C.DOCUMENTED).alias("documented_result"),
    )


@query("targets_render")
def targets_render(spark, sf_dir):
    rendered = text.quoted_list(F.col("targets"))
    return V.decisions(spark, sf_dir).select(
        "seq", rendered.alias("rendered"), F.to_json("targets").alias("json")
    )


# --- Traffic ------------------------------------------------------------------


def _moving(spark, sf_dir):
    return traffic.speeds(traffic.sightings(V.positions(spark, sf_dir), V.DAY))


@query("vehicle_first_last")
def vehicle_first_last(spark, sf_dir):
    return _moving(spark, sf_dir).select(
        window_key(),
        "vn",
        "first_lat",
        "first_lon",
        "last_lat",
        "last_lon",
        clock("first_ts"),
        clock("last_ts"),
        "reports",
    )


@query("vehicle_speed")
def vehicle_speed(spark, sf_dir):
    return _moving(spark, sf_dir).select(
        window_key(), "vn", *rounded("distance_km", "speed_kmh"), "congested"
    )


@query("traffic_score")
def traffic_score(spark, sf_dir):
    return traffic.traffic_scores(_moving(spark, sf_dir)).select(
        window_key(), "vehicles", "congested", *rounded("traffic_score")
    )


@query("slowest_vehicles")
def slowest_vehicles(spark, sf_dir):
    return traffic.slowest(_moving(spark, sf_dir)).select(
        window_key(), "vn", *rounded("speed_kmh"), clock("first_ts")
    )


@query("target_top5")
def target_top5(spark, sf_dir):
    aims = traffic.targets(_moving(spark, sf_dir)).filter(F.size("targets") > 0)
    return aims.select(window_key(), F.array_join("targets", "|").alias("targets"))


@query("sliding_traffic")
def sliding_traffic(spark, sf_dir):
    return traffic.sliding_traffic(V.positions(spark, sf_dir)).select(
        window_key(), "vehicles", "congested", *rounded("traffic_score")
    )


# --- Combination and decision -------------------------------------------------


@query("sentiment_ratio")
def sentiment_ratio(spark, sf_dir):
    return mood.negative_share(V.moods(spark, sf_dir), V.DAY).select(
        window_key(), "tweets", "negative", *rounded("sentiment_ratio")
    )


@query("combine_signals")
def combine_signals(spark, sf_dir):
    """Hourly signals; errors are the messages, all other events the vehicles."""
    rows = V.events(spark, sf_dir)
    is_message = F.col("event_type") == "error"
    instant = F.col("window.end").alias("instant")
    driving = traffic.tumbling_traffic(V.positions_of(rows.filter(~is_message)), V.HOUR)
    talking = mood.negative_share(V.moods_of(rows.filter(is_message)), V.HOUR)
    hourly = weather.scores(store.latest_per_key(V.forecast(spark, sf_dir), "row_key", ["seq"]))
    signals = combine.combine_signals(
        driving.select(instant, "traffic_score"),
        hourly.select(F.col("ts").alias("instant"), "weather_score"),
        talking.select(instant, F.col("sentiment_ratio").alias("sentiment_score")),
    )
    return signals.select(
        clock("instant"),
        *rounded("traffic_score", "weather_score", "sentiment_score"),
        "traffic_found",
        "weather_found",
        "sentiment_found",
    )


@query("weather_at_decision")
def weather_at_decision(spark, sf_dir):
    current = store.latest_per_key(V.forecast(spark, sf_dir), "row_key", ["seq"])
    made = V.decisions(spark, sf_dir).select("seq", F.col("decision_time").alias("instant"))
    return weather.weather_at(made, current).select(
        "seq", "hour_key", *rounded("weather_score"), "weather_found"
    )


@query("weather_air_join")
def weather_air_join(spark, sf_dir):
    now = store.latest_per_key(V.forecast(spark, sf_dir), "row_key", ["seq"])
    air = store.latest_per_key(V.forecast(spark, sf_dir, V.AIR), "row_key", ["seq"])
    return weather.with_air_quality(now, air).select(
        "row_key", *rounded("temp_2m", "rain", "pm10", "ozone", "ragweed_pollen")
    )


@query("rain_congestion_join")
def rain_congestion_join(spark, sf_dir):
    wet = (
        V.forecast(spark, sf_dir)
        .groupBy(F.window("ts", V.DAY).alias("window"))
        .agg(F.max("rain").alias("rain"))
    )
    stuck = traffic.traffic_scores(_moving(spark, sf_dir))
    return combine.rain_with_congestion(wet, stuck).select(
        window_key(), *rounded("rain"), "congested", *rounded("traffic_score")
    )


def _decisions_out(made: DataFrame) -> DataFrame:
    return made.select(
        "decision_id",
        *rounded(*schemas.SCORES),
        "decision_result",
        "campaign_type",
        F.array_join("targets", "|").alias("targets"),
        clock("decision_time"),
        clock("display_time"),
    )


def _forecast(spark, sf_dir):
    return store.latest_per_key(V.forecast(spark, sf_dir), "row_key", ["seq"])


@query("decide")
def decide(spark, sf_dir):
    """The flagship: three feeds to daily decisions with their targets."""
    rows = V.events(spark, sf_dir)
    reports_, talk = V.positions_of(rows), V.moods_of(rows)
    return _decisions_out(decision_plan(reports_, talk, _forecast(spark, sf_dir), length=V.DAY))


@query("decide_sliding")
def decide_sliding(spark, sf_dir):
    """The same over the configured look-back window, a decision every minute."""
    rows = V.events(spark, sf_dir)
    reports_, talk = V.positions_of(rows), V.moods_of(rows)
    return _decisions_out(decision_plan(reports_, talk, _forecast(spark, sf_dir)))


@query("end_to_end")
def end_to_end(spark, sf_dir):
    """Raw messages of three feeds, parsed, scored, stored, decided by day and archived."""
    root = scratch(spark, "city")
    feeds.store_feeds(
        root,
        vehicles=V.vehicle_messages(spark, sf_dir),
        tweets=V.tweet_messages(spark, sf_dir),
        weather=V.hourly_messages(spark, sf_dir, schemas.WEATHER, V.WEATHER),
        lexicon=V.lexicon(spark),
    )
    made = feeds.decide_stored(spark, root, length=V.DAY)
    archive.archive_increment(spark, made, f"{root}/archive", "20250101_000000")
    return archive.read_base(spark, f"{root}/archive").select(
        "decision_id",
        *rounded(*schemas.SCORES),
        "decision_result",
        "campaign_type",
        "target_locations",
        "decision_time",
        "display_time",
    )


@query("latest_state")
def latest_state(spark, sf_dir):
    return state.latest_state(_district_decisions(spark, sf_dir), order=["decision_id", "seq"])


def _district_decisions(spark, sf_dir) -> DataFrame:
    district = F.concat(F.lit("district_"), F.pmod("user_id", F.lit(V.DISTRICTS)).cast("string"))
    return V.decisions(spark, sf_dir).withColumn("area", district)


# --- Reports ------------------------------------------------------------------


@query("decision_distribution")
def decision_distribution(spark, sf_dir):
    rows = reports.decision_distribution(V.archive_view(spark, sf_dir))
    return rows.select("decision_result", "decisions", *averaged("avg_score"))


@query("show_rate")
def show_rate(spark, sf_dir):
    rows = reports.show_rate(V.archive_view(spark, sf_dir))
    return rows.select("total", *rounded("show_rate_pct"))


@query("daily_show_rate")
def daily_show_rate(spark, sf_dir):
    return reports.daily_show_rate(V.archive_view(spark, sf_dir))


@query("rush_vs_offpeak")
def rush_vs_offpeak(spark, sf_dir):
    rows = reports.rush_vs_offpeak(V.archive_view(spark, sf_dir))
    return rows.select("period", *averaged("avg_traffic", "avg_weather", "avg_global"))


@query("summary_by_decision")
def summary_by_decision(spark, sf_dir):
    rows = reports.summary_by_decision(V.archive_view(spark, sf_dir))
    numbers = [f"{kind}_{score}" for score in schemas.SCORES for kind in ("avg", "std")]
    return rows.select("decision_result", "decisions", *averaged("pct", *numbers))


@query("describe_scores")
def describe_scores(spark, sf_dir):
    rows = reports.describe_scores(V.archive_view(spark, sf_dir))
    return rows.select("score", "n", *averaged("mean", "std"), *rounded("min", "q25", "q50", "q75", "max"))


@query("score_histogram")
def score_histogram(spark, sf_dir):
    rows = reports.score_histogram(V.archive_view(spark, sf_dir))
    return rows.select("score", "bin", *rounded("bin_lo", "bin_hi"), "n", *averaged("mean"), *rounded("median"))


@query("score_boxplot")
def score_boxplot(spark, sf_dir):
    rows = reports.score_boxplot(V.archive_view(spark, sf_dir))
    return rows.select(
        "decision_result",
        "score",
        *rounded("q25", "q50", "q75", "whisker_low", "whisker_high"),
        "outliers",
    )


@query("score_correlation")
def score_correlation(spark, sf_dir):
    rows = reports.score_correlation(V.archive_view(spark, sf_dir))
    return rows.select("score_a", "score_b", *rounded("corr"))


@query("corr_with_global")
def corr_with_global(spark, sf_dir):
    return reports.corr_with_global(V.archive_view(spark, sf_dir)).select("score", *rounded("corr"))


_PARTIALS: dict[tuple[str, str], str] = {}
STOPS = ("20240110_000000", "20240120_123456", "20240201_000000")


def _partials(spark, sf_dir) -> DataFrame:
    """Partials kept by three archive runs, once per session and input."""
    configure(spark)
    place = (spark.sparkContext.applicationId, sf_dir)
    if place not in _PARTIALS:
        path = scratch(spark, "partials")
        rows = V.decisions(spark, sf_dir)
        for stop in STOPS:
            partials.archive_increment(spark, rows, f"{path}/archive", f"{path}/hours", stop)
        _PARTIALS[place] = f"{path}/hours"
    return partials.read(spark, _PARTIALS[place])


@query("partial_distribution")
def partial_distribution(spark, sf_dir):
    rows = partials.decision_distribution(_partials(spark, sf_dir))
    return rows.select("decision_result", "decisions", *averaged("avg_score"))


@query("partial_show_rate")
def partial_show_rate(spark, sf_dir):
    return partials.show_rate(_partials(spark, sf_dir)).select("total", *rounded("show_rate_pct"))


@query("partial_daily_show_rate")
def partial_daily_show_rate(spark, sf_dir):
    return partials.daily_show_rate(_partials(spark, sf_dir))


@query("partial_rush_vs_offpeak")
def partial_rush_vs_offpeak(spark, sf_dir):
    rows = partials.rush_vs_offpeak(_partials(spark, sf_dir))
    return rows.select("period", *averaged("avg_traffic", "avg_weather", "avg_global"))


@query("partial_summary")
def partial_summary(spark, sf_dir):
    rows = partials.summary_by_decision(_partials(spark, sf_dir))
    numbers = [f"{kind}_{score}" for score in schemas.SCORES for kind in ("avg", "std")]
    return rows.select("decision_result", "decisions", *averaged("pct", *numbers))


@query("partial_correlation")
def partial_correlation(spark, sf_dir):
    rows = partials.score_correlation(_partials(spark, sf_dir))
    return rows.select("score_a", "score_b", *rounded("corr"))


@query("scatter_pairs")
def scatter_pairs(spark, sf_dir):
    rows = reports.scatter_pairs(V.archive_view(spark, sf_dir))
    return rows.select("decision_id", "decision_result", "score", "x", *rounded("global_score"))


@query("score_timeseries")
def score_timeseries(spark, sf_dir):
    rows = reports.score_timeseries(V.archive_view(spark, sf_dir))
    return rows.select("decision_id", "decision_time", *rounded(*schemas.SCORES))


@query("hourly_pattern")
def hourly_pattern(spark, sf_dir):
    rows = reports.hourly_pattern(V.archive_view(spark, sf_dir))
    averages = [f"avg_{score}" for score in schemas.SCORES]
    return rows.select("hr", "decisions", *averaged(*averages, "show_rate_pct"))


@query("most_triggered_days")
def most_triggered_days(spark, sf_dir):
    return reports.most_triggered_days(V.archive_view(spark, sf_dir))


@query("dataset_overview")
def dataset_overview(spark, sf_dir):
    return reports.dataset_overview(V.archive_view(spark, sf_dir))


@query("top10_scores")
def top10_scores(spark, sf_dir):
    rows = V.archive_view(spark, sf_dir).withColumn("global_score", F.round("global_score", ROUND))
    return reports.top_scores(rows)


@query("top5_days")
def top5_days(spark, sf_dir):
    rows = reports.top_days(V.archive_view(spark, sf_dir))
    return rows.select("dt", *averaged("avg_score"), *rounded("max_score"), "decisions")


# --- Streaming ----------------------------------------------------------------


def _stream(spark, sf_dir, name) -> DataFrame:
    schema = V.table(spark, sf_dir, name).schema
    return envelopes.read_table_stream(spark, f"{sf_dir}/{name}.parquet", schema)


def _event_stream(spark, sf_dir) -> DataFrame:
    return V.from_events(_stream(spark, sf_dir, "events"))


def _vehicle_stream(spark, sf_dir) -> DataFrame:
    """Vehicle rows of the streamed messages, written in arrival order."""
    messages = envelopes.envelopes(V.vehicle_records(_event_stream(spark, sf_dir)))
    rows = parse.parse_vehicles(messages, "bus", ingested_at=F.col("kafka_ts"))
    good, _ = parse.quarantine_vehicles(rows)
    return good.withColumn("seq", F.unix_micros("ingestion_timestamp"))


STORED = ("row_key", "vehicle_number", "gps_time", "lat", "lon", "seq")


@query("stream_ingest")
def stream_ingest(spark, sf_dir):
    table = store.KeyedTable(spark, scratch(spark, "vehicles"))
    ingest.ingest_all(_vehicle_stream(spark, sf_dir), table, scratch(spark, "checkpoint"))
    return table.latest().select(*STORED)


@query("stream_replay_idempotent")
def stream_replay_idempotent(spark, sf_dir):
    """The stream is replayed from the start by the same writer, under the same batch ids."""
    table = store.KeyedTable(spark, scratch(spark, "vehicles"))
    rows = _vehicle_stream(spark, sf_dir)
    for _ in range(2):
        ingest.ingest_all(rows, table, scratch(spark, "checkpoint"), writer="vehicles")
    return table.log().agg(
        F.count("*").alias("logged"), F.countDistinct("row_key", "seq").alias("distinct_writes")
    )


REDELIVERED_AFTER = "1 hour"


@query("stream_once")
def stream_once(spark, sf_dir):
    """The feed is delivered twice, under keys cut from the time of processing: one row a report."""
    inbox, checkpoint = scratch(spark, "inbox"), scratch(spark, "checkpoint")
    table = store.KeyedTable(spark, scratch(spark, "vehicles"))
    records = V.vehicle_records(V.events(spark, sf_dir))
    later = (F.col("timestamp") + F.expr(f"INTERVAL {REDELIVERED_AFTER}")).alias("timestamp")
    for delivery in (records, records.select("value", later)):
        delivery.write.mode("append").parquet(inbox)
        messages = envelopes.read_envelopes(spark, inbox, format="parquet")
        rows = parse.parse_vehicles(
            messages, "bus", event_time="processing", ingested_at=F.col("kafka_ts")
        )
        good, _ = parse.quarantine_vehicles(rows)
        timed = good.withColumn("at", F.try_to_timestamp("gps_time", F.lit(keys.CLOCK_TIME)))
        reported = ["lines", "vehicle_number", "brigade", "at", "lat", "lon"]
        first = ingest.once(timed, reported, "at")
        first = first.withColumn("seq", F.unix_micros("ingestion_timestamp"))
        ingest.ingest_all(first, table, checkpoint)
    return table.log().select("row_key", "vehicle_number", "gps_time", "lat", "lon")


@query("stream_latest_state")
def stream_latest_state(spark, sf_dir):
    """The serving record kept by a stream whose deliveries come newest first."""
    rows = _district_decisions(spark, sf_dir).select(
        "area", "decision_id", *schemas.SCORES, "decision_result", "seq"
    )
    inbox, checkpoint = scratch(spark, "inbox"), scratch(spark, "checkpoint")
    table = store.KeyedTable(
        spark, scratch(spark, "state"), "area", ["decision_id", "seq"], source_order=True
    )
    early = F.col("decision_id") < RANGE[1]
    for delivery in (rows.filter(~early), rows.filter(early)):
        delivery.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(rows.schema).parquet(inbox)
        ingest.keep_latest(stream, table, checkpoint, every=None).awaitTermination()
    return state.served(table.latest())


@query("stream_shared_table")
def stream_shared_table(spark, sf_dir):
    """Two feeds write one table; one of them restarts on a fresh checkpoint."""
    table = store.KeyedTable(spark, scratch(spark, "vehicles"))
    rows = _vehicle_stream(spark, sf_dir)
    odd = F.pmod(F.xxhash64("vehicle_number"), F.lit(2)) == 1
    for feed in (rows.filter(odd), rows.filter(~odd), rows.filter(~odd)):
        ingest.ingest_all(feed, table, scratch(spark, "checkpoint"))
    return table.latest().select(*STORED)


def _ingested_forecast(spark, sf_dir, formulas) -> DataFrame:
    """Forecast rows as they stream in; a later poll of an hour overwrites it."""
    rows = V.forecast_of(V.polls_of(_stream(spark, sf_dir, "orders")), formulas)
    table = store.KeyedTable(spark, scratch(spark, "forecast"))
    return ingest.ingest_all(rows, table, scratch(spark, "checkpoint")).latest()


@query("stream_ingest_weather")
def stream_ingest_weather(spark, sf_dir):
    return _ingested_forecast(spark, sf_dir, V.WEATHER).select(
        "row_key", "seq", *rounded("temp_2m", "rain", "wind_gusts"), "cloud_cover"
    )


@query("stream_ingest_air")
def stream_ingest_air(spark, sf_dir):
    return _ingested_forecast(spark, sf_dir, V.AIR).select("row_key", "seq", *rounded(*V.AIR))


@query("stream_ingest_tweets")
def stream_ingest_tweets(spark, sf_dir):
    """Messages scored on the way into their table; some ids come twice with another text."""
    posted = V.with_edits(V.posts_of(_stream(spark, sf_dir, "documents")))
    rows = parse.parse_tweets(V.tweet_messages_of(posted), ingested_at=INGESTED)
    good, _ = parse.quarantine_keyed(rows)
    scored = mood.bucketed(mood.score_rows(good, V.lexicon(spark)))
    table = store.KeyedTable(spark, scratch(spark, "tweets"), order=["data_acquisition_date"])
    ingest.ingest_all(scored, table, scratch(spark, "checkpoint"))
    return table.latest().select(
        "row_key",
        "tweet_id",
        "matches",
        "sentiment_score",
        F.round("compound", 4).alias("compound"),
        F.char_length("text").alias("chars"),
    )


@query("stream_traffic")
def stream_traffic(spark, sf_dir):
    scored = windows.stream_traffic(V.positions_of(_event_stream(spark, sf_dir)), V.DAY)
    out = scratch(spark, "traffic")
    windows.run_to_files(scored, out, scratch(spark, "checkpoint"))
    return spark.read.parquet(out).select(
        window_key(), "vehicles", "congested", *rounded("traffic_score")
    )


@query("stream_sliding_traffic")
def stream_sliding_traffic(spark, sf_dir):
    """The stream writes closed steps, windows over them follow."""
    steps = windows.stream_steps(V.positions_of(_event_stream(spark, sf_dir)))
    out = scratch(spark, "steps")
    until = windows.run_to_files(steps, out, scratch(spark, "checkpoint"))
    return windows.sliding_traffic_of(spark.read.schema(steps.schema).parquet(out), until).select(
        window_key(), "vehicles", "congested", *rounded("traffic_score")
    )


@query("stream_rain_congestion")
def stream_rain_congestion(spark, sf_dir):
    """Vehicle and forecast streams joined on their day."""
    rain = V.forecast_of(V.polls_of(_stream(spark, sf_dir, "orders"))).select("ts", "rain")
    joined = windows.stream_rain_congestion(
        V.positions_of(_event_stream(spark, sf_dir)), rain, V.DAY
    )
    out = scratch(spark, "joined")
    windows.run_to_files(joined, out, scratch(spark, "checkpoint"))
    return spark.read.parquet(out).select(
        window_key(), *rounded("rain"), "congested", *rounded("traffic_score")
    )


ARRIVALS = ("2024-01-09", "2024-01-17", "2024-01-25", None)


@query("stream_decide")
def stream_decide(spark, sf_dir):
    """Vehicle and message streams write their closed windows, decisions follow."""
    rows = _event_stream(spark, sf_dir)
    streams = {
        "speeds": windows.stream_speeds(V.positions_of(rows), V.DAY),
        "moods": windows.stream_negative_share(V.moods_of(rows), V.DAY),
    }
    emitted, marks = [], []
    for name, stream in streams.items():
        out = scratch(spark, name)
        marks.append(windows.run_to_files(stream, out, scratch(spark, "checkpoint")))
        emitted.append(spark.read.parquet(out))
    until = windows.earliest(marks)
    final = windows.decidable(*emitted, until)
    made = decide_windows(*final, _forecast(spark, sf_dir), step=V.DAY, until=until)
    return _decisions_out(made)


@query("stream_decide_chained")
def stream_decide_chained(spark, sf_dir):
    """Both streams meet inside one streaming query, which emits the decisions themselves."""
    rows = _event_stream(spark, sf_dir)
    made = windows.stream_decisions(
        V.positions_of(rows), V.moods_of(rows), _forecast(spark, sf_dir), V.DAY
    )
    out = scratch(spark, "decided")
    windows.run_to_files(made, out, scratch(spark, "checkpoint"))
    return _decisions_out(spark.read.parquet(out))


@query("stream_late_data")
def stream_late_data(spark, sf_dir):
    """Events arrive ``value`` minutes after they happened, in four deliveries.

    Each delivery is one run of the same stream, so whatever lies behind the
    watermark of the runs before it is late.
    """
    arrival = F.timestamp_micros(
        F.unix_micros("ts") + (F.col("value") * F.lit(60_000_000)).cast("bigint")
    )
    rows = V.events(spark, sf_dir).select("e", "ts", arrival.alias("arrival"))
    inbox, out, checkpoint = (scratch(spark, p) for p in ("inbox", "counted", "checkpoint"))
    after = mark = None
    for until in ARRIVALS:
        part = rows
        if after:
            part = part.filter(F.col("arrival") >= F.lit(after).cast("timestamp"))
        if until:
            part = part.filter(F.col("arrival") < F.lit(until).cast("timestamp"))
        part.write.mode("append").parquet(inbox)
        stream = spark.readStream.schema(rows.schema).parquet(inbox)
        counted = (
            stream.withWatermark("ts", windows.LATENESS)
            .groupBy(F.window("ts", V.HOUR).alias("window"))
            .agg(F.count("*").alias("n"))
        )
        mark = windows.run_to_files(counted, out, checkpoint) or mark
        after = until
    late = windows.late_rows(spark.read.parquet(out), rows, V.HOUR, until=mark)
    return late.select(window_key(), "on_time", "late")
