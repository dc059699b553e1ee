"""Voxel coordinates: every resolution is expressed on the 8 nm grid."""

from __future__ import annotations

from enum import IntEnum


class Resolution(IntEnum):
    """Voxel size in nanometres of the volume an edge table was computed on."""

    NM8 = 8
    NM16 = 16
    NM32 = 32

    @property
    def factor(self) -> int:
        """Multiplier that takes a coordinate to the 8 nm grid."""
        return self.value // 8

    @property
    def scale(self) -> int:
        """``factor`` as a power of two."""
        return self.factor.bit_length() - 1

    @classmethod
    def of_table(cls, name: str) -> Resolution:
        """Resolution named by the digits of an edge table such as ``rsg16``."""
        digits = name.removeprefix("rsg")
        if digits == name or not digits.isdigit() or int(digits) not in list(cls):
            raise ValueError(
                f"edge table {name!r} does not name a resolution; expected one of "
                f"{[f'rsg{r.value}' for r in cls]}"
            )
        return cls(int(digits))


def scale_to_float(coordinate: str, res: Resolution | int) -> str:
    """Full-resolution coordinate as a double."""
    return f"{float(2 ** Resolution(res).scale)}D * {coordinate}"


def scale_to_integer(coordinate: str, res: Resolution | int) -> str:
    """Full-resolution coordinate as a bigint; fractional input rounds half away from zero."""
    return f"bigint(round({Resolution(res).factor} * {coordinate}))"


def box_end(start: str, size: str) -> str:
    """Exclusive upper corner of a box given its lower corner and extent."""
    return f"{start} + {size}"
