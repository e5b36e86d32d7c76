"""Era-normalised popularity ranking on Spark DataFrames."""

from evergreen.config import Floor, MeasureDim, Settings
from evergreen.plans.scores import Sources, ranked_songs, song_list

__all__ = ["Floor", "MeasureDim", "Settings", "Sources", "ranked_songs", "song_list"]
