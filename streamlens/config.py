"""Typed job settings."""

from __future__ import annotations

from dataclasses import dataclass
from typing import Sequence

MALFORMED_POLICIES = ("fail", "drop", "quarantine")
SOLVERS = ("exact", "sgd")
SEMANTICS = ("replace_batch", "append", "logged")
TABLE_SOURCES = ("catalog", "orc")


@dataclass(frozen=True)
class JobConfig:
    """Everything the streaming job can be told; defaults are the documented ones.

    ``num_corrections`` only says how near an iterative quasi-Newton solver
    stops to the minimiser; it is accepted so that existing command lines keep
    working, and has no effect because ``solver="exact"`` computes the
    minimiser itself.  ``num_iterations``, ``step_size``, ``convergence_tol``
    and ``init_weight`` matter for ``solver="sgd"``.
    """

    brokers: str = ""
    topics: str = ""
    num_iterations: int = 100
    step_size: float = 0.01
    convergence_tol: float = 0.00001
    init_weight: float = 0.0
    reg_param: float = 0.0001
    num_corrections: int = 5

    # Default batch interval, table locations, band and limits.
    batch_interval: str = "10 seconds"
    reviews_path: str = "/apps/hive/warehouse/restaurants.db/reviews"
    restaurants_path: str = "/apps/hive/warehouse/restaurants.db/restaurants"
    reviews_table: str = "restaurants.reviews"
    restaurants_table: str = "restaurants.restaurants"
    results_table: str = "restaurants.results"
    output_topic: str = "MyTest"
    half_width: float = 0.0005
    min_rating: float = 3.0
    lng_low: float = 13.3
    lng_high: float = 13.4
    result_limit: int | None = 5
    sgd_reg_param: float = 0.000001

    solver: str = "exact"
    on_malformed: str = "fail"
    semantics: str = "replace_batch"
    tables_from: str = "catalog"
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int | None = None
    broadcast_bytes: int = 32 * 1024 * 1024

    # Per batch, off unless asked for: features divided by their deviation, a part held
    # out of the fit, statistics and metrics written, tokens printed to the console.
    scale: bool = False
    holdout: float = 0.0
    statistics: bool = False
    preview_rows: int = 0

    def __post_init__(self) -> None:
        for name, value, allowed in (
            ("on_malformed", self.on_malformed, MALFORMED_POLICIES),
            ("solver", self.solver, SOLVERS),
            ("semantics", self.semantics, SEMANTICS),
            ("tables_from", self.tables_from, TABLE_SOURCES),
        ):
            if value not in allowed:
                raise ValueError(f"{name} must be one of {allowed}, not {value!r}")
        if self.half_width <= 0:
            raise ValueError("half_width must be positive")
        if not 0 <= self.holdout < 1:
            raise ValueError("holdout must be a fraction below 1")
        if self.reg_param < 0:
            raise ValueError("reg_param must not be negative")

    @property
    def topic_list(self) -> list[str]:
        """Topics without duplicates; names are not trimmed, empty ones at the end are none."""
        return sorted(set(self.topics.rstrip(",").split(",")))

    @classmethod
    def from_args(cls, args: Sequence[str], **overrides) -> "JobConfig":
        """Build a config from the eight positional command-line arguments."""
        if len(args) < 8:
            raise ValueError(
                "usage: <brokers> <topics> <numIterations> <stepSize> <convergenceTol>"
                " <initWeight> <regParam> <numCorrections>"
            )
        return cls(
            brokers=args[0],
            topics=args[1],
            num_iterations=int(args[2]),
            step_size=float(args[3]),
            convergence_tol=float(args[4]),
            init_weight=float(args[5]),
            reg_param=float(args[6]),
            num_corrections=int(args[7]),
            **overrides,
        )
