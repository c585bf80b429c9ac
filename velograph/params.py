"""Every parameter that changes a result, in one immutable object with a fingerprint."""

from __future__ import annotations

import dataclasses
import hashlib
import json
from dataclasses import dataclass, field

# The defaults that results depend on.
STUDY_BOX = (19.792238, 49.967665, 20.217346, 50.126135)
ROAD_BOX = (19.65, 49.90, 20.30, 50.22)
DEFAULT_SPEEDS = {
    "motorway": 140, "motorway_link": 90, "trunk": 120, "trunk_link": 80, "primary": 50, "primary_link": 50, "secondary": 50,
    "secondary_link": 50, "tertiary": 50, "tertiary_link": 50, "unclassified": 50, "residential": 50, "living_street": 20, "service": 30,
}


@dataclass(frozen=True)
class Params:
    """Boxes are west, south, east, north; distances in metres, speeds in km/h, times in seconds. The defaults are fixed values, too."""

    period: tuple[str, str] = ("2021-01-01", "2023-12-31")
    study_box: tuple[float, float, float, float] = STUDY_BOX
    road_box: tuple[float, float, float, float] = ROAD_BOX
    local_zone: str = "Europe/Warsaw"
    primary_timestamp: str = "GPS_TIME_UTC"
    max_disagreement: int = 300
    primary_radius: float = 15.0
    radii: tuple[float, float, float] = (15.0, 25.0, 40.0)
    diagnostic_radius: float = 150.0
    grid_cell: float = 100.0
    speed_source: str = "gps_speed"
    speed_factor: float = 0.036
    speed_range: tuple[float, float] = (0.0, 150.0)
    running_above: float = 2.0
    max_gap: int = 30
    min_heading_move: float = 1.0
    heading_weight: float = 0.35
    iqr_multiplier: float = 3.0
    iqr_min_group: int = 20
    min_samples: int = 10
    keep_sensitivity_only: bool = False
    drop_outliers: bool = True
    weather_model: str = "era5"
    scope_inside: str = "OFFICIAL_BOUNDING_BOX"
    scope_outside: str = "EXTENDED_PROCESSING_AREA"
    default_speeds: dict[str, int] = field(default_factory=lambda: dict(DEFAULT_SPEEDS))

    def __post_init__(self) -> None:
        """Refuse what no result could be right under."""
        for name, (west, south, east, north) in (("study_box", self.study_box), ("road_box", self.road_box)):
            if not (-180 <= west < east <= 180 and -90 <= south < north <= 90):
                raise ValueError(f"{name} is no box: {(west, south, east, north)}")
        inner, outer = self.study_box, self.road_box
        checks = {
            "study_box must lie in road_box": outer[0] <= inner[0] and outer[1] <= inner[1] and inner[2] <= outer[2] and inner[3] <= outer[3],
            "period must not end before it begins": self.period[0] <= self.period[1],
            "radii must ascend from above zero": 0 < self.radii[0] < self.radii[1] < self.radii[2],
            "primary_radius must be one of radii": self.primary_radius in self.radii,
            "speed_source must be gps_speed or displacement": self.speed_source in ("gps_speed", "displacement"),
            "primary_timestamp is unknown": self.primary_timestamp in ("GPS_TIME_UTC", "ETL_CZAS_LOCAL"),
            "speed_range must ascend": 0 <= self.speed_range[0] < self.speed_range[1],
            "heading_weight must lie within 0 and 1": 0 <= self.heading_weight <= 1,
            "counts, gaps and factors must be above zero": min(self.max_gap, self.speed_factor, self.iqr_min_group, self.min_samples, self.iqr_multiplier, self.grid_cell) > 0,
        }
        if failed := [text for text, ok in checks.items() if not ok]:
            raise ValueError("; ".join(failed))

    def canonical(self) -> str:
        return json.dumps(dataclasses.asdict(self), sort_keys=True, separators=(",", ":"))

    def fingerprint(self) -> str:
        """SHA-256 over all parameters in canonical JSON."""
        return hashlib.sha256(self.canonical().encode()).hexdigest()

    @property
    def weather_years(self) -> tuple[int, ...]:
        return tuple(range(int(self.period[0][:4]), int(self.period[1][:4]) + 1))
