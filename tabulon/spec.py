"""Column roles of a labelled table."""
from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DatasetSpec:
    """Which column plays which role; operators skip columns a frame lacks."""

    id_col: str
    label_col: str
    continuous: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    flags: tuple[str, ...] = ()
    geo: tuple[str, ...] = ()
    age_col: str | None = None
    allowed: dict[str, tuple[str, ...]] = field(default_factory=dict)

    def present(self, df, role: str) -> list[str]:
        have = set(df.columns)
        return [c for c in getattr(self, role) if c in have]


# Column roles and allowed codes of the public building-damage dataset.
BUILDING_DAMAGE = DatasetSpec(
    id_col="building_id",
    label_col="damage_grade",
    continuous=("count_floors_pre_eq", "age", "area_percentage", "height_percentage", "count_families"),
    categorical=(
        "land_surface_condition", "foundation_type", "roof_type", "ground_floor_type",
        "other_floor_type", "position", "plan_configuration", "legal_ownership_status",
    ),
    flags=(
        "has_superstructure_adobe_mud", "has_superstructure_mud_mortar_stone",
        "has_superstructure_stone_flag", "has_superstructure_cement_mortar_stone",
        "has_superstructure_mud_mortar_brick", "has_superstructure_cement_mortar_brick",
        "has_superstructure_timber", "has_superstructure_bamboo",
        "has_superstructure_rc_engineered", "has_superstructure_rc_non_engineered",
        "has_superstructure_other", "has_secondary_use", "has_secondary_use_agriculture",
        "has_secondary_use_hotel", "has_secondary_use_rental", "has_secondary_use_institution",
        "has_secondary_use_school", "has_secondary_use_industry", "has_secondary_use_health_post",
        "has_secondary_use_gov_office", "has_secondary_use_use_police", "has_secondary_use_other",
        "monum_flag",
    ),
    geo=("geo_level_1_id", "geo_level_2_id", "geo_level_3_id"),
    age_col="age",
    allowed={
        "land_surface_condition": ("n", "o", "t"),
        "foundation_type": ("h", "i", "r", "u", "w"),
        "roof_type": ("n", "q", "x"),
        "ground_floor_type": ("f", "m", "v", "x", "z"),
        "other_floor_type": ("j", "q", "s", "x"),
        "position": ("j", "o", "s", "t"),
        "plan_configuration": ("a", "c", "d", "f", "m", "n", "o", "q", "s", "u"),
        "legal_ownership_status": ("a", "r", "v", "w"),
    },
)
