"""What a read looks like: the parameters of every query over reads."""

from __future__ import annotations

from dataclasses import dataclass, replace

MODES = ("hamming", "edit")
#: Places of a fixed-size key under c_limits: three fields of at most 256 and their separators.
KEY_CAPACITY = 771


@dataclass(frozen=True)
class ReadLayout:
    """[outer5] umi5 inner5 BARCODE inner3 umi3 [outer3]

    max_errors holds for each anchor apart. mode "hamming" counts substitutions only, "edit" also insertions and
    deletions. An empty outer anchor is one that is not given. Anchors are literal text; in edit mode regex_anchors takes
    them as pattern source. c_limits also rejects UMIs of 256 characters or more, and layouts whose sort keys (both UMIs and
    the barcode with their separators) could not be kept in KEY_CAPACITY characters.
    """

    inner5: str
    inner3: str
    barcode_length: int
    outer5: str | None = None
    outer3: str | None = None
    min_umi: int = 1
    max_umi: int = 100
    max_errors: int = 2
    mode: str = "hamming"
    regex_anchors: bool = False
    c_limits: bool = False

    def __post_init__(self):
        if not self.inner5 or not self.inner3:
            raise ValueError("inner5 and inner3 are required")
        if self.barcode_length <= 0:
            raise ValueError("barcode_length must be over 0")
        if self.mode not in MODES:
            raise ValueError(f"mode must be one of {MODES}")
        if self.max_errors < 0 or self.min_umi < 0:
            raise ValueError("max_errors and min_umi cannot be negative")
        if self.c_limits and self.barcode_length + 2 * self.max_umi + 3 >= KEY_CAPACITY:
            raise ValueError(f"barcode_length and twice max_umi must stay under {KEY_CAPACITY - 3}")
        if self.regex_anchors and self.mode != "edit":
            raise ValueError("regex_anchors needs mode edit")
        object.__setattr__(self, "outer5", self.outer5 or None)
        object.__setattr__(self, "outer3", self.outer3 or None)

    def with_(self, **changes) -> ReadLayout:
        return replace(self, **changes)

    @property
    def most_umi(self) -> int:
        """The length of the longest UMI that is accepted."""
        return min(self.max_umi, 255) if self.c_limits else self.max_umi
