"""Ranking parameters.  Everything a run can vary is a field here."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class MeasureDim:
    """One source of per-song totals: its columns, weight and first tracked year."""

    name: str
    value_col: str
    score_col: str
    weight: float
    start_year: int | None = None
    #: Its plain titles name the song, and playlist floors apply to it; at most one measure.
    trusted: bool = False


@dataclass(frozen=True)
class Floor:
    """Membership in ``playlist`` implies at least ``value`` of the streams measure."""

    playlist: str
    value: int


# Names, weights, launch years and thresholds that define the default ranking.
DEFAULT_MEASURES = (
    MeasureDim("streams", "spotify_streams", "sp_score", 0.25, trusted=True),
    MeasureDim("videos", "youtube_views", "yt_score", 0.15),
    MeasureDim("store", "itunes_total", "itunes_score", 0.10, 2010),
    MeasureDim("subscription", "apple_total", "apple_score", 0.10, 2017),
)
DEFAULT_FLOORS = (Floor("playlist_hi", 500_000_000), Floor("playlist_lo", 100_000_000))
DEFAULT_ALIASES = {
    "soulja boy tellem": "soulja boy",
    "lillywood": "lilly wood and the prick",
    "lady a": "lady antebellum",
}


@dataclass(frozen=True)
class Settings:
    """Weights, windows, floors, aliases and report sizes of one ranking run."""

    chart_weight: float = 0.40
    peak_weight: float = 0.60
    half_window: int = 5
    measures: tuple[MeasureDim, ...] = DEFAULT_MEASURES
    floors: tuple[Floor, ...] = DEFAULT_FLOORS
    aliases: dict[str, str] = field(default_factory=lambda: dict(DEFAULT_ALIASES))
    variant_word: str = "remix"
    top_n: int = 2500
    chart_top_n: int = 200
    source_top_n: int = 500
    candidate_pool_n: int = 2000

    def measure(self, name: str) -> MeasureDim:
        return next(m for m in self.measures if m.name == name)

    @property
    def trusted(self) -> MeasureDim | None:
        return next((m for m in self.measures if m.trusted), None)
