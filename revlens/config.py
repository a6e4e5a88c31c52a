"""Parameters of the jobs. Values marked fixed must keep results equal to the published ones."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class RiskBands:
    """Score cuts. fixed values: the shipped pair, and the pair used by the notebook report."""

    high: float = 0.20
    medium: float = 0.08


SHIPPED_BANDS = RiskBands()
REPORT_BANDS = RiskBands(high=0.68, medium=0.30)


@dataclass(frozen=True)
class TrainConfig:
    """Feature widths, classifier and search settings. fixed values."""

    comment_buckets: int = 256
    title_buckets: int = 128
    min_doc_freq: int = 2
    max_iter: int = 100
    reg_param: float = 0.01
    elastic_net: float = 0.0
    grid_reg: tuple[float, ...] = (0.001, 0.01, 0.1)
    grid_iter: tuple[int, ...] = (50, 100)
    folds: int = 3
    seed: int = 42
    train_percent: int = 80
    min_rows: int = 1000
    parallelism: int = 3
    share_fits: bool = True


# weak-label path and observed-revert path differ in these settings (fixed values)
WEAK = TrainConfig()
HISTORY = TrainConfig(min_doc_freq=5, reg_param=0.0)


@dataclass(frozen=True)
class JobConfig:
    """Locations and switches of the batch and streaming jobs."""

    work_dir: str
    dump_paths: tuple[str, ...] = ()
    history_paths: tuple[str, ...] = ()
    phases: tuple[str, ...] = ("parse", "features", "label", "train")
    placeholder_parent: bool = False
    row_cap: int | None = None
    bands: RiskBands = SHIPPED_BANDS
    train: TrainConfig | None = None  # the job's own settings: WEAK or HISTORY

    def path(self, name: str) -> str:
        return f"{self.work_dir.rstrip('/')}/{name}"
