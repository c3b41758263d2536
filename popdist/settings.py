"""Application and module settings.

The defaults and checks follow the reference's settings files; values are
plain Python so one job can carry many modules (cohorts) at once.
"""

from __future__ import annotations

from dataclasses import asdict, dataclass, field

# Fixed values that must equal the reference (app settings file).
STATE_PREFIX = "Prescribe_"
INGREDIENT_SUFFIX = "_ingredient_distribution"
PRODUCT_SUFFIX = "_product_distribution"
DEFAULT_AGE_RANGES = (
    "0-3", "4-7", "8-11", "12-17", "18-25", "26-35", "36-45", "46-65", "65-103",
)
# Term types allowed by the ingredient term-type filter.
INGREDIENT_TTYS = ("IN", "MIN")
# Demographic flags, in the order they become grouping columns.
DEMOGRAPHIC_ORDER = ("age", "gender", "state")


@dataclass(frozen=True)
class AppSettings:
    state_prefix: str = STATE_PREFIX
    ingredient_distribution_suffix: str = INGREDIENT_SUFFIX
    product_distribution_suffix: str = PRODUCT_SUFFIX
    default_age_ranges: tuple[str, ...] = DEFAULT_AGE_RANGES


@dataclass(frozen=True)
class ClassQuery:
    class_id: str
    relationship: str


@dataclass(frozen=True)
class ModuleSettings:
    """One module (cohort).  ``None`` flags count as on, as in the reference."""

    module_name: str
    name: str | None = None
    assign_to_attribute: str | None = None
    reason: str | None = None
    as_needed: bool | None = False
    chronic: bool | None = False
    refills: int | None = 0
    rxclass_include: tuple[ClassQuery, ...] | None = None
    rxclass_exclude: tuple[ClassQuery, ...] | None = None
    rxcui_include: tuple[str, ...] | None = None
    rxcui_exclude: tuple[str, ...] | None = None
    ingredient_tty_filter: str | None = None
    dose_form_filter: tuple[str, ...] | None = None
    age_ranges: tuple[str, ...] | None = None
    flags: dict = field(default_factory=lambda: {"age": True, "gender": True, "state": True})

    def __post_init__(self):
        if self.rxclass_include is None and self.rxcui_include is None:
            raise ValueError(f"module {self.module_name!r} includes neither a class nor an id")
        if self.ingredient_tty_filter is not None and not isinstance(self.ingredient_tty_filter, str):
            raise ValueError("ingredient_tty_filter must be a string")

    # -- derived values ---------------------------------------------------
    def demographics(self) -> list[str]:
        """Grouping columns chosen by the flags (``v != False`` is on)."""
        return [k for k in DEMOGRAPHIC_ORDER if self.flags.get(k, True) is not False]

    def flag(self, name: str) -> bool:
        return self.flags.get(name, True) is not False

    def bands(self, app: AppSettings = AppSettings()) -> tuple[str, ...]:
        return tuple(self.age_ranges) if self.age_ranges is not None else tuple(app.default_age_ranges)

    def as_dict(self) -> dict:
        return asdict(self)


def parse_band(band: str) -> tuple[int, int]:
    """'lo-hi' -> (lo, hi), both inclusive."""
    lo, hi = band.split("-")
    return int(lo), int(hi)
