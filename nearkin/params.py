"""Run parameters: shingle width, signature length, banding and result size."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class LshParams:
    """``bands`` bands of ``rows`` values each are cut from a ``num_hashes``-long signature."""

    shingle_k: int = 3
    num_hashes: int = 50
    bands: int = 10
    rows: int = 5
    top_k: int = 10
    seed: int = 42

    def __post_init__(self):
        for name in ("shingle_k", "num_hashes", "bands", "rows", "top_k"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")
        check_banding(self.num_hashes, self.bands, self.rows)

    def but(self, **changes) -> "LshParams":
        return replace(self, **changes)


def check_banding(num_hashes: int, bands: int, rows: int) -> None:
    """A band beyond the signature would be empty, and every document would share its bucket."""
    if bands * rows > num_hashes:
        raise ValueError(f"{bands} bands of {rows} rows need {bands * rows} hashes, got {num_hashes}")


DEV = LshParams()
CLUSTER = LshParams(num_hashes=100, bands=20)
