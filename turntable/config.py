"""Tunables of the batch jobs and the folder layout they share."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import datetime


@dataclass(frozen=True)
class EngineConfig:
    # Defaults the jobs are specified with.
    ranks: tuple[int, ...] = (8, 12)
    lambdas: tuple[float, ...] = (0.1, 10.0)
    iterations: tuple[int, ...] = (10, 20)
    alpha: float = 3.0
    split_weights: tuple[int, int, int] = (4, 1, 1)
    seed: int = 45
    train_window_days: int = 180
    generation_window_days: int = 7
    top_artists_limit: int = 20
    similar_artists_limit: int = 10
    top_artist_recommendations: int = 30
    similar_artist_recommendations: int = 30
    stats_epoch: datetime = datetime(2002, 1, 1)

    model_id_prefix: str = "turntable-model"
    # ALS user and item blocks; None derives them from the number of ratings.
    als_blocks: int | None = None
    # Fits of the grid that run at the same time.
    grid_parallelism: int = 4
    # Recordings of an artist that are scored before the norms of the others are looked at.
    norm_block: int = 256
    # Longest list nested into one row of per-user statistics.
    page_size: int = 10_000


@dataclass(frozen=True)
class Layout:
    """Where the jobs keep their tables, below one root folder.

    Each build of the dataframes has a folder of its own, named by its id, and so has each run that makes candidate
    sets. A row of metadata, written last, makes it the newest. A layout may be bound to a build and a run; an unbound
    one looks up the newest when a path is asked for, so a job binds its layout once and keeps reading the same tables.
    """

    root: str
    build: str | None = None
    candidate_run: str | None = None

    def of(self, build: str, candidate_run: str | None = None) -> Layout:
        return replace(self, build=build, candidate_run=candidate_run)

    @property
    def listens(self) -> str:
        return f"{self.root}/listens"

    @property
    def artists_relation(self) -> str:
        return f"{self.root}/artists_relation"

    def _of_build(self, table: str) -> str:
        from turntable.sources.builds import newest_build

        return f"{self.root}/dataframes/{self.build or newest_build(self)}/{table}"

    @property
    def users(self) -> str:
        return self._of_build("users")

    @property
    def recordings(self) -> str:
        return self._of_build("recordings")

    @property
    def playcounts(self) -> str:
        return self._of_build("playcounts")

    @property
    def build_steps(self) -> str:
        return f"{self.root}/dataframes_steps"

    def ids(self, dimension: str) -> str:
        return f"{self.root}/ids/{dimension}"

    @property
    def candidate_runs(self) -> str:
        return f"{self.root}/candidate_runs"

    def _of_candidates(self, table: str) -> str:
        from turntable.sources.builds import newest_candidate_run

        return f"{self.root}/candidate_sets/{self.candidate_run or newest_candidate_run(self)}/{table}"

    @property
    def top_artist_set(self) -> str:
        return self._of_candidates("top_artist")

    @property
    def similar_artist_set(self) -> str:
        return self._of_candidates("similar_artist")

    @property
    def candidate_artists(self) -> str:
        return self._of_candidates("artists")

    @property
    def user_status(self) -> str:
        return self._of_candidates("user_status")

    @property
    def similar_artist_report(self) -> str:
        return self._of_candidates("similar_artist_report")

    @property
    def model_metadata(self) -> str:
        return f"{self.root}/models/metadata"

    @property
    def model_runs(self) -> str:
        return f"{self.root}/models/runs"

    def model(self, model_id: str) -> str:
        return f"{self.root}/models/data/{model_id}"

    @property
    def recommendations(self) -> str:
        return f"{self.root}/recommendations/playlists"

    @property
    def recommendation_status(self) -> str:
        return f"{self.root}/recommendations/user_status"

    @property
    def monthly_artists(self) -> str:
        return f"{self.root}/monthly/artists"

    @property
    def counted_months(self) -> str:
        return f"{self.root}/monthly/counted"
