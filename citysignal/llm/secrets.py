"""Secret scans with multipart linking, in DataFrame functions only.

Strong findings (``assign``, ``access``, ``hex``) stand alone. Weak candidates are parts of a
credential that mean little alone: an identifier (``ident``), a bare mixed token
(``secret``) and an ``endpoint``. Parts are intervals of a text; scopes are the stretches
between blank lines. Parts are joined to the scopes that hold them and to each other by
interval: same text, same scope, at most ``REACH`` code points apart. A weak identifier is
reported when a secret is near, a weak secret when an identifier is near, an endpoint when
both are.

Joins run over (text digest, bin of ``BIN`` code points), so a bin holds few parts and no
pair is emitted (semi-joins). Only texts with a weak candidate enter them, each distinct
text once; copies share the outcome by digest, so hot texts cost one row a task.

Null and empty texts have no spans. Repeated rows and null ids keep their rows; nothing is
keyed by id. Overlapping candidates inside a strong span are not reported again. Offsets
count code points from 0, ends are exclusive. Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citysignal.llm.common import only, restored, shielded, small_side, text_of, written

REACH = 200
BIN = 512
LINKED_ROWS = 100_000
MARK = "[SECRET]"

# The patterns of the kinds, in the order in which kinds are listed.
ASSIGN = (
    "([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]"
    "|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    "[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_LEAST = 12
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"
IDENT = (
    "([Aa][Cc][Cc][Ee][Ss][Ss]_?[Kk][Ee][Yy]_?[Ii][Dd]|[Cc][Ll][Ii][Ee][Nn][Tt]_?[Ii][Dd]"
    "|[Uu][Ss][Ee][Rr]([Nn][Aa][Mm][Ee])?|[Ll][Oo][Gg][Ii][Nn])"
    "[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9_.@+-]{4,}"
)
SECRET = "[A-Za-z0-9+/_=-]{20,}"
ENDPOINT = (
    "(https?|jdbc:[a-z]+|postgres|mysql|mongodb|redis|amqp)://[A-Za-z0-9._~:/?#@!$&()*+,;=%-]{4,}"
    "|([Hh][Oo][Ss][Tt]|[Ee][Nn][Dd][Pp][Oo][Ii][Nn][Tt])[\"']?\\x20*[:=]\\x20*[\"']?[A-Za-z0-9.-]{4,}"
)
BLANK = "\\n[\\x20\\t\\r]*\\n"
KINDS = ("assign", "access", "hex", "ident", "secret", "endpoint")
NO_SPANS = "array<struct<start:int,stop:int,kind:string>>"


def rank_of(kind: Column) -> Column:
    return F.array_position(F.array(*map(F.lit, KINDS)), kind)


def found(text: Column, kind: str, pattern: str, fits=None, needs: str | None = None) -> Column:
    """All matches of ``pattern`` from the left as (start, stop, kind).

    ``fits`` tells from (match, group 2) whether it counts; ``needs`` is a cheaper pattern
    without which there is none.
    """
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    tails = F.regexp_extract_all(text, F.lit(pattern), F.lit(2)) if fits == "tail" else matches
    gaps = F.slice(F.split(text, pattern), 1, F.size(matches))
    pieces = F.arrays_zip(gaps.alias("gap"), matches.alias("match"), tails.alias("tail"))

    def place(at: Column, x: Column) -> Column:
        start = at["at"] + F.char_length(x["gap"])
        stop = start + F.char_length(x["match"])
        span = F.struct(start.alias("start"), stop.alias("stop"), F.lit(kind).alias("kind"))
        if fits == "tail":
            counts = F.char_length(x["tail"]) >= ASSIGN_LEAST
        elif fits:
            counts = fits(x["match"])
        else:
            counts = F.lit(True)
        more = F.when(counts, F.array(span)).otherwise(F.array().cast(NO_SPANS))
        return F.struct(stop.alias("at"), F.concat(at["spans"], more).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), F.array().cast(NO_SPANS).alias("spans"))
    spans = F.aggregate(pieces, begin, place, lambda at: at["spans"])
    return F.when(F.rlike(text, F.lit(needs or pattern)), spans).otherwise(
        F.array().cast(NO_SPANS)
    )


def mixed(token: Column) -> Column:
    return F.rlike(token, F.lit("[0-9]")) & F.rlike(token, F.lit("[A-Z]")) & F.rlike(token, F.lit("[a-z]"))


def strong(text: Column) -> dict[str, Column]:
    return {
        "assign": found(text, "assign", ASSIGN, "tail", ASSIGN[:-1].removesuffix("+") + f"{{{ASSIGN_LEAST},}})"),
        "access": found(text, "access", ACCESS),
        "hex": found(text, "hex", HEX),
    }


def candidates(docs: DataFrame) -> DataFrame:
    """digest, parts (strong and weak) and scopes of the distinct texts that have a weak part."""
    text = F.col("body")
    weak = F.concat(
        found(text, "ident", IDENT), found(text, "secret", SECRET, mixed), found(text, "endpoint", ENDPOINT)
    )
    some = F.rlike(text, F.lit(IDENT)) | F.rlike(text, F.lit(SECRET)) | F.rlike(text, F.lit(ENDPOINT))
    parts = only(docs, "text").select(text_of().alias("body")).where(some)
    parts = parts.select(
        F.sha2(text, 256).alias("digest"),
        weak.alias("weak"),
        F.concat(*strong(text).values()).alias("strong"),
        found(text, "blank", BLANK).alias("blanks"),
        F.char_length(text).alias("length"),
    )
    apart = F.filter(
        "weak",
        lambda w: ~F.exists(
            "strong", lambda s: (s["start"] < w["stop"]) & (w["start"] < s["stop"])
        ),
    )
    parts = parts.withColumn("weak", apart).where(F.size("weak") > 0)
    # Scopes: from the end of one blank stretch to the start of the next.
    starts = F.concat(F.array(F.lit(0)), F.transform("blanks", lambda b: b["stop"]))
    stops = F.concat(F.transform("blanks", lambda b: b["start"]), F.array("length"))
    return parts.groupBy("digest").agg(
        F.first(F.concat("weak", "strong")).alias("parts"),
        F.first(F.arrays_zip(starts.alias("start"), stops.alias("stop"))).alias("scopes"),
    )


def _bins(start: Column, stop: Column, reach: int = 0) -> Column:
    low = F.floor((start - reach) / BIN)
    return F.explode(F.sequence(low, F.floor((stop + reach) / BIN)))


def linked(docs: DataFrame) -> DataFrame:
    """digest and ``links``, the weak parts to report, for texts that have some."""
    texts = written(candidates(docs), "secret-parts")
    scopes = texts.select("digest", F.explode("scopes").alias("s")).select(
        "digest",
        F.col("s.start").alias("scope"),
        F.col("s.stop").alias("scope_stop"),
        _bins(F.col("s.start"), F.col("s.stop")).alias("bin"),
    )
    parts = (
        texts.select("digest", F.explode("parts").alias("p"))
        .select("digest", "p.*", F.floor(F.col("p.start") / BIN).alias("bin"))
        .join(scopes, ["digest", "bin"])
        .where((F.col("start") >= F.col("scope")) & (F.col("start") <= F.col("scope_stop")))
        .groupBy("digest", "start", "stop", "kind")
        .agg(F.max("scope").alias("scope"))
    )

    def near(df: DataFrame, kinds: tuple[str, ...]) -> DataFrame:
        """Rows of ``df`` with a part of one of the kinds in reach, in their scope."""
        mine = df.withColumn("bin", _bins(F.col("start"), F.col("stop"), REACH)).alias("a")
        others = (
            parts.where(F.col("kind").isin(*kinds))
            .withColumn("bin", _bins(F.col("start"), F.col("stop")))
            .alias("b")
        )
        same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("digest", "bin", "scope")]
        reach = (F.col("b.start") <= F.col("a.stop") + REACH) & (
            F.col("b.stop") + REACH >= F.col("a.start")
        )
        hit = mine.join(others, [*same, reach], "left_semi")
        return hit.drop("bin").distinct()

    secrets, idents = ("assign", "hex", "secret"), ("access", "ident")
    of = lambda kind: parts.where(F.col("kind") == kind)
    reported = (
        near(of("ident"), secrets)
        .unionByName(near(of("secret"), idents))
        .unionByName(near(near(of("endpoint"), secrets), idents))
    )
    return reported.groupBy("digest").agg(
        F.collect_set(F.struct("start", "stop", "kind")).alias("links")
    )


def _ordered(spans: Column) -> Column:
    ranked = F.transform(
        spans, lambda s: F.struct(s["start"], rank_of(s["kind"]).alias("rank"), s["stop"], s["kind"])
    )
    return F.transform(
        F.sort_array(ranked), lambda s: F.struct(s["start"], s["stop"], s["kind"])
    )


def spelled(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def scan(docs: DataFrame, *keep: str) -> DataFrame:
    """For each row the kept columns, the strong spans by kind, ``base`` and ``spans``."""
    links = linked(docs).withColumnRenamed("digest", "link_digest")
    text = text_of()
    base = only(docs, "text", *keep).select(
        *keep,
        F.sha2(text, 256).alias("text_digest"),
        *(spans.alias(f"in_{kind}") for kind, spans in strong(text).items()),
    ).withColumn("base", _ordered(F.concat("in_assign", "in_access", "in_hex")))
    return base.join(links, F.col("text_digest") == F.col("link_digest"), "left").withColumn(
        "spans",
        F.when(F.col("links").isNull(), F.col("base")).otherwise(_ordered(F.concat("base", "links"))),
    )


def cut(text: Column, spans: Column, mark: str = MARK) -> Column:
    """``text`` with every span, overlapping ones together, replaced by ``mark``."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(done: Column, s: Column) -> Column:
        fresh = s["start"] >= done["at"]
        gap = F.substring(text, done["at"] + 1, s["start"] - done["at"])
        return F.struct(
            F.greatest(done["at"], s["stop"]).alias("at"),
            F.when(fresh, F.concat(done["out"], gap, F.lit(mark)))
            .otherwise(done["out"])
            .alias("out"),
        )

    return F.aggregate(
        spans, begin, step, lambda done: F.concat(done["out"], F.substring(text, done["at"] + 1, F.char_length(text)))
    )


def redact(docs: DataFrame, mark: str = MARK) -> DataFrame:
    """``docs`` with all reported spans replaced in the texts; every row and column stays."""
    links = small_side(written(linked(docs), "secret-links"), LINKED_ROWS)
    inner, text = shielded(docs, "text"), text_of()
    spans = F.concat(*strong(text).values())
    joined = inner.withColumn("base", spans).join(
        links, F.sha2(text, 256) == F.col("digest"), "left"
    )
    spans = _ordered(F.concat("base", F.coalesce("links", F.array().cast(NO_SPANS))))
    cleaned = F.when(F.size("spans") > 0, cut(text, F.col("spans"), mark)).otherwise(F.col("text"))
    return restored(joined.withColumn("spans", spans), docs.columns, cleaned)
