"""Typed parameters: edge kinds, thresholds and table names."""

from __future__ import annotations

import dataclasses
import math
from dataclasses import dataclass
from enum import Enum
from numbers import Integral, Real
from typing import Any

from edgelens.functions.bounds import Bounds
from edgelens.functions.geometry import Resolution

# Fixed value: the tissue class an edge must lie in at both ends.
# 1 out of bounds, 2 trachea, 3 glia, 4 cell bodies, 5 neuropil
NEUROPIL = 5


class EdgeType(str, Enum):
    """Which edges a query looks for."""

    INTER_BODY = "inter-body"
    INTRA_BODY = "intra-body"


def _field_name(name: str) -> str:
    """Accept ``min_sv_size_both`` as well as ``__MIN_SV_SIZE_BOTH__``."""
    return name.strip("_").lower() if name.startswith("__") else name.lower()


class _Replaceable:
    """``replace`` with name checking for the frozen dataclasses below."""

    def replace(self, **changes: Any):
        known = {f.name for f in dataclasses.fields(self)}
        renamed = {_field_name(k): v for k, v in changes.items()}
        if unknown := sorted(renamed.keys() - known):
            raise ValueError(f"unknown parameters {unknown}; known are {sorted(known)}")
        return dataclasses.replace(self, **renamed)


@dataclass(frozen=True)
class EdgeCriteria(_Replaceable):
    """Edge kind and the inclusive thresholds an edge must meet.

    The defaults are fixed values: as wide as the attributes get.
    """

    edge_type: EdgeType = EdgeType.INTER_BODY

    min_two_way_score: float = 0.0
    max_two_way_score: float = 1.0
    min_one_way_score: float = 0.0
    max_one_way_score: float = 1.0

    min_body_tbars_both: float = 0
    max_body_tbars_both: float = 1e6
    min_body_tbars_either: float = 0
    max_body_tbars_either: float = 1e6

    min_sv_tbars_both: float = 0
    max_sv_tbars_both: float = 1e6
    min_sv_tbars_either: float = 0
    max_sv_tbars_either: float = 1e6

    min_body_size_both: float = 0
    max_body_size_both: float = 1e11
    min_body_size_either: float = 0
    max_body_size_either: float = 1e11

    min_sv_size_both: float = 0
    max_sv_size_both: float = 1e11
    min_sv_size_either: float = 0
    max_sv_size_either: float = 1e11

    def __post_init__(self) -> None:
        object.__setattr__(self, "edge_type", EdgeType(self.edge_type))
        for field in dataclasses.fields(self)[1:]:
            value = getattr(self, field.name)
            if isinstance(value, bool) or not isinstance(value, Real) or math.isnan(value):
                raise ValueError(f"{field.name} must be a number, got {value!r}")
            plain = int(value) if isinstance(value, Integral) else float(value)
            object.__setattr__(self, field.name, plain)

    @property
    def scores(self) -> Bounds:
        return Bounds(
            self.min_two_way_score,
            self.max_two_way_score,
            self.min_one_way_score,
            self.max_one_way_score,
            whole_numbers=False,
        )

    @property
    def body_tbars(self) -> Bounds:
        return self._family("body_tbars")

    @property
    def sv_tbars(self) -> Bounds:
        return self._family("sv_tbars")

    @property
    def body_size(self) -> Bounds:
        return self._family("body_size")

    @property
    def sv_size(self) -> Bounds:
        return self._family("sv_size")

    def _family(self, name: str) -> Bounds:
        values = [
            getattr(self, f"{limit}_{name}_{ends}")
            for ends in ("both", "either")
            for limit in ("min", "max")
        ]
        return Bounds(*values)

    def as_parameters(self) -> dict[str, Any]:
        """Plain values for a provenance record."""
        values = dataclasses.asdict(self)
        values["edge_type"] = self.edge_type.value
        return values


@dataclass(frozen=True)
class TableNames(_Replaceable):
    """Physical table names. ``base_seg`` is the schema that holds them all.

    The defaults are fixed values: the names under which such datasets are stored.
    ``rsg_table`` is the edge table of a query at one resolution; queries over several take the
    three tables by resolution. ``sv_dimension_table`` and ``skew_table`` name a stored
    supervoxel dimension and skew profile of the same tables, where there are any.
    """

    base_seg: str
    rsg_table: str = "rsg8"
    sv_objinfo_table: str = "objinfo"
    sv_mask_class_table: str = "obj_to_mask"
    sv_tbar_count_table: str = "agglo_rsg32_16_sep_8_sep1e6_sv_tbar_counts"
    sv_excl_table: str = "svs_to_keep_isolated"
    agglo_table: str = "agglo_rsg32_16_sep_8_sep1e6_id_to_rep"
    agglo_body_size_table: str = "agglo_rsg32_16_sep_8_sep1e6_body_sizes"
    body_tbar_count_table: str = "agglo_rsg32_16_sep_8_sep1e6_body_tbar_counts"
    sv_mut_excl_table: str = "svs_to_keep_separate_from_eachother"
    rsg8_table: str = "rsg8"
    rsg16_table: str = "rsg16"
    rsg32_table: str = "rsg32"
    sv_dimension_table: str = ""
    skew_table: str = ""

    def __post_init__(self) -> None:
        Resolution.of_table(self.rsg_table)

    @property
    def res(self) -> Resolution:
        """Resolution of the edge table; the coordinate scale always follows it."""
        return Resolution.of_table(self.rsg_table)

    def at(self, res: Resolution | int) -> str:
        """Name of the edge table of a resolution."""
        return getattr(self, f"rsg{int(Resolution(res))}_table")

    def as_parameters(self) -> dict[str, Any]:
        return {**dataclasses.asdict(self), "scale": self.res.scale}
