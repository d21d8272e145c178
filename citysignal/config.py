"""Scoring parameters, feed retention and search defaults.

Everything a caller may want to tune lives here as plain data; the column
builders in :mod:`citysignal.functions` turn it into Catalyst expressions.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# --- Fixed values -----------------------------------------------------------
# These numbers and words define the scores; results depend on them exactly.

EARTH_RADIUS_KM = 6371.0

RUSH_HOURS = (7, 8, 9, 16, 17, 18)
RUSH_MULTIPLIER = 1.2

# Apparent temperature in degrees Celsius.
COLD_BANDS = ((0.0, 0.4), (10.0, 0.3), (15.0, 0.15))  # colder than -> points
HOT_BANDS = ((30.0, 0.3), (25.0, 0.15))  # hotter than -> points

# More than -> points.
PRECIPITATION_BANDS_MM = ((10.0, 0.3), (5.0, 0.2), (1.0, 0.1), (0.1, 0.05))
SNOW_SURCHARGE_BANDS_MM = ((0.5, 0.1),)
SNOW_DEPTH_BANDS_CM = ((30.0, 0.25), (20.0, 0.2), (10.0, 0.15), (5.0, 0.1), (1.0, 0.05))
WIND_BANDS_KMH = ((50.0, 0.2), (30.0, 0.15), (20.0, 0.1), (10.0, 0.05))

# WMO present-weather codes.
SEVERE_CODES = (67, 75, 85, 86, 95, 96, 99)
SEVERE_POINTS = 0.1
MODERATE_CODES = (61, 63, 65, 71, 73, 77, 80, 81, 82)
MODERATE_POINTS = 0.05

# Compound polarity -1..1 is mapped to a 0..9 bucket; below 4 is negative.
SENTIMENT_SCALE = 4.5
SENTIMENT_MAX_BUCKET = 9
NEGATIVE_BELOW_BUCKET = 4
MISSING_BUCKET = 5
# Hutto & Gilbert (ICWSM 2014): compound = s / sqrt(s^2 + alpha).
POLARITY_ALPHA = 15.0

SHOW_AD = "SHOW_AD"
NO_AD = "NO_AD"
CAMPAIGN = "ESCAPISM_NOW"

SEARCH_CENTRE = (52.2297, 21.0122)
SEARCH_RADIUS_KM = 20.0
SEARCH_SINCE = "24 hours"
SEARCH_KEYWORDS = (
    "zmęczony",
    "zmeczony",
    "korek",
    "smog",
    "zimno",
    "nienawidzę",
    "depresja",
)

# How long each feed is kept.
RETENTION = {
    "vehicles": "24 hours",
    "tweets": "24 hours",
    "weather": "48 hours",
    "air_quality": "48 hours",
    "decisions": "7 days",
}
# -----------------------------------------------------------------------------


@dataclass(frozen=True)
class ScoringConfig:
    """Weights and cut-offs of the decision.

    The defaults are the running configuration; :data:`DOCUMENTED` is the
    alternative blend that the design material describes.
    """

    traffic_weight: float = 0.4
    weather_weight: float = 0.4
    sentiment_weight: float = 0.2
    show_above: float = 0.5

    congested_above_kmh: float = 0.1
    congested_below_kmh: float = 15.0
    targets_per_decision: int = 5
    display_delay: str = "5 minutes"

    window: str = "10 minutes"
    slide: str = "1 minute"

    # Feed units -> scoring units.
    snowfall_to_mm: float = 100.0
    snow_depth_to_cm: float = 100.0
    # Off reproduces a pipeline in which the code never reaches the scorer.
    use_weather_code: bool = True
    rush_hours: tuple[int, ...] = field(default=RUSH_HOURS)
    rush_multiplier: float = RUSH_MULTIPLIER


DEFAULT = ScoringConfig()
DOCUMENTED = ScoringConfig(
    traffic_weight=0.5, weather_weight=0.3, sentiment_weight=0.2, show_above=0.6
)
