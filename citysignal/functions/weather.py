"""Weather discomfort: one expression per factor, summed into a 0..1 score.

A missing measure contributes nothing; the other factors still count.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from citysignal import config as C


def _first_match(rules: Iterable[tuple[Column, float]]) -> Column:
    """CASE over the rules in order, zero when none applies (also for null input)."""
    return F.coalesce(*[F.when(test, F.lit(points)) for test, points in rules], F.lit(0.0))


def points_above(value: Column, bands: Iterable[tuple[float, float]]) -> Column:
    return _first_match((value > F.lit(limit), points) for limit, points in bands)


@dataclass(frozen=True)
class WeatherFactors:
    """Readings in scoring units and the points each one earns."""

    temperature: Column
    rain_mm: Column
    snow_mm: Column
    depth_cm: Column
    wind_kmh: Column
    code: Column
    has_precipitation: Column
    use_code: bool = True

    @classmethod
    def of(
        cls,
        temp: Column,
        apparent: Column,
        rain: Column,
        snowfall: Column,
        snow_depth: Column,
        wind: Column,
        code: Column,
        config: C.ScoringConfig = C.DEFAULT,
    ) -> WeatherFactors:
        return cls(
            temperature=F.coalesce(apparent, temp),
            rain_mm=F.coalesce(rain, F.lit(0.0)),
            snow_mm=F.coalesce(snowfall * F.lit(config.snowfall_to_mm), F.lit(0.0)),
            depth_cm=snow_depth * F.lit(config.snow_depth_to_cm),
            wind_kmh=wind,
            code=code,
            has_precipitation=rain.isNotNull() | snowfall.isNotNull(),
            use_code=config.use_weather_code,
        )

    @classmethod
    def of_forecast(cls, config: C.ScoringConfig = C.DEFAULT) -> WeatherFactors:
        """Factors over the columns of the forecast table."""
        names = (
            "temp_2m",
            "apparent_temp",
            "rain",
            "snowfall",
            "snow_depth",
            "wind_speed",
            "weather_code",
        )
        return cls.of(*map(F.col, names), config=config)

    def temperature_points(self) -> Column:
        cold = [(self.temperature < F.lit(limit), pts) for limit, pts in C.COLD_BANDS]
        hot = [(self.temperature > F.lit(limit), pts) for limit, pts in C.HOT_BANDS]
        return _first_match(cold + hot)

    def precipitation_points(self) -> Column:
        return points_above(self.rain_mm + self.snow_mm, C.PRECIPITATION_BANDS_MM)

    def snow_points(self) -> Column:
        return points_above(self.snow_mm, C.SNOW_SURCHARGE_BANDS_MM)

    def depth_points(self) -> Column:
        return points_above(self.depth_cm, C.SNOW_DEPTH_BANDS_CM)

    def wind_points(self) -> Column:
        return points_above(self.wind_kmh, C.WIND_BANDS_KMH)

    def code_points(self) -> Column:
        if not self.use_code:
            return F.lit(0.0)
        return _first_match(
            [
                (self.code.isin(*C.SEVERE_CODES), C.SEVERE_POINTS),
                (self.code.isin(*C.MODERATE_CODES), C.MODERATE_POINTS),
            ]
        )

    def points(self) -> dict[str, Column]:
        return {
            "temperature_points": self.temperature_points(),
            "precipitation_points": self.precipitation_points(),
            "snow_points": self.snow_points(),
            "depth_points": self.depth_points(),
            "wind_points": self.wind_points(),
            "code_points": self.code_points(),
        }

    def total(self) -> Column:
        total = F.lit(0.0)
        for points in self.points().values():
            total = total + points
        return total

    def score(self, hour: Column, config: C.ScoringConfig = C.DEFAULT) -> Column:
        """Sum of the points, raised in the rush hour, capped at one."""
        total = self.total()
        factor = F.when(hour.isin(*config.rush_hours), F.lit(config.rush_multiplier)).otherwise(
            F.lit(1.0)
        )
        return F.least(total * factor, F.lit(1.0))

    def explain(self, hour: Column, config: C.ScoringConfig = C.DEFAULT) -> Column:
        """Readable list of the factors that took part, in scoring order."""
        notes = [
            F.when(
                self.temperature.isNotNull(), F.format_string("temp=%.1f°C", self.temperature)
            ),
            F.when(self.has_precipitation, F.format_string("rain=%.1fmm", self.rain_mm)),
            F.when(self.snow_mm > 0, F.format_string("snow=%.1fmm", self.snow_mm)),
            F.when(
                self.depth_cm.isNotNull(), F.format_string("snow_depth=%.1fcm", self.depth_cm)
            ),
            F.when(self.wind_kmh.isNotNull(), F.format_string("wind=%.1fkm/h", self.wind_kmh)),
        ]
        if self.use_code:
            notes.append(
                F.when(
                    self.code.isin(*C.SEVERE_CODES), F.format_string("severe_weather=%d", self.code)
                ).when(
                    self.code.isin(*C.MODERATE_CODES),
                    F.format_string("moderate_weather=%d", self.code),
                )
            )
        notes.append(
            F.when(
                hour.isin(*config.rush_hours) & (self.total() > 0),
                F.lit(f"rush_hour_x{config.rush_multiplier}"),
            )
        )
        return F.concat_ws(", ", *notes)
