"""Job parameters and their validation."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class InterpolationParams:
    """Parameters of one interpolation run.

    ``cutoff`` and ``width`` are in the units of the projected coordinates; ``buffer_m`` is the
    distance in metres by which the region is widened when input nodes are selected. A key whose refined
    grid would have more than ``max_nodes`` nodes is not interpolated and says so in ``status``.
    """

    res_factor: int = 8
    cutoff: float = 20.0
    width: float = 1.0
    subsample_pct: float = 50.0
    nfold: int = 5
    nmax: int = 32
    test_pct: float = 10.0
    seed: int = 123
    buffer_m: float | None = None
    max_nodes: int = 1_000_000_000

    def __post_init__(self):
        if int(self.res_factor) != self.res_factor or self.res_factor < 1:
            raise ValueError("res_factor must be a positive whole number")
        if int(self.nmax) != self.nmax or self.nmax < 1:
            raise ValueError("nmax must be a positive whole number")
        if not 0 < self.subsample_pct <= 100:
            raise ValueError("subsample_pct must be above 0 and at most 100")
        if not 0 < self.test_pct < 100:
            raise ValueError("test_pct must be between 0 and 100")
        if int(self.nfold) != self.nfold or self.nfold < 2:
            raise ValueError("nfold must be a whole number of at least 2")
        if not (self.cutoff > 0 and self.width > 0 and self.width <= self.cutoff):
            raise ValueError("cutoff and width must be positive, width at most cutoff")
        if self.buffer_m is not None and self.buffer_m < 0:
            raise ValueError("buffer_m must not be negative")
        if self.max_nodes < 1:
            raise ValueError("max_nodes must be positive")
