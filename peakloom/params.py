"""Run parameters and the precursor tolerance."""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, field

_TOLERANCE = re.compile(r"^\s*([0-9]*\.?[0-9]+(?:[eE][+-]?[0-9]+)?)\s*(ppm|da)\s*$", re.IGNORECASE)


@dataclass(frozen=True)
class Tolerance:
    """A precursor window: absolute (Da) or relative to the larger mass (ppm)."""

    value: float
    unit: str

    @classmethod
    def parse(cls, text: str | Tolerance) -> Tolerance:
        if isinstance(text, Tolerance):
            return text
        match = _TOLERANCE.match(text)
        if not match:
            raise ValueError(f"tolerance needs a number and a unit (ppm or Da), got {text!r}")
        value, unit = float(match.group(1)), match.group(2).lower()
        if value <= 0 or (unit == "ppm" and value >= 1e6):
            raise ValueError(f"tolerance out of range: {text!r}")
        return cls(value, unit)

    @property
    def relative(self) -> float:
        return self.value * 1e-6

    @property
    def span(self) -> float:
        """Window length on the axis used for bucketing: m/z for Da, ln(m/z) for ppm.

        ``hi - lo <= r * hi`` is the same as ``ln(hi) - ln(lo) <= -ln(1 - r)``, so one bucket
        length fits all masses.
        """
        return self.value if self.unit == "da" else -math.log1p(-self.relative)


@dataclass(frozen=True)
class ClusterParams:
    """Settings of one run; defaults are those of the published workflow."""

    precursor_tol: Tolerance = field(default_factory=lambda: Tolerance(20.0, "ppm"))
    fragment_tol: float = 0.05
    min_mz_range: float = 0.0
    min_mz: float = 0.0
    max_mz: float = 30000.0
    eps: float = 0.1
    min_samples: int = 2
    hash_len: int | None = None
    sample_size: int = 5
    sample_seed: str = "0"
    do_networking: bool = True
    min_cosine: float = 0.7
    min_matched_peaks: int | None = None
    score: str = "cosine"
    max_shift: float | None = None
    peak_filter: bool = False
    approximate: bool = False
    probes: int = 16
    neighbours: int = 64

    def __post_init__(self) -> None:
        object.__setattr__(self, "precursor_tol", Tolerance.parse(self.precursor_tol))
        if self.fragment_tol <= 0:
            raise ValueError("fragment_tol must be positive")
        if not 0 < self.eps < 1:
            raise ValueError("eps is a cosine distance and must lie between 0 and 1")
        if self.min_samples < 2:
            raise ValueError("min_samples counts the spectrum itself and must be 2 or more")
        if not 0 < self.min_cosine <= 1:
            raise ValueError("min_cosine must lie between 0 and 1")
        if self.probes < 1 or self.neighbours < 1:
            raise ValueError("probes and neighbours must be positive")
        if self.score not in ("cosine", "entropy"):
            raise ValueError("score is cosine or entropy")
        if self.max_shift is not None and self.max_shift < 0:
            raise ValueError("max_shift must not be negative")

    @property
    def similarity(self) -> float:
        return 1.0 - self.eps
