"""Run configuration: date window, division rules and thresholds."""

from __future__ import annotations

import dataclasses
import datetime as _dt
import enum

from basketspark.errors import InputNotValidError

# Fixed values of the job (they must equal the original job's for equal results).
MIN_CONFIDENCE = 0.2  # pairs below this confidence are not recommended
TOP_K = 35  # dense-rank cut-off per viewed SKU
MAX_GROUPS_PER_BASKET = 30  # sessions with more distinct groups are scrapers
RARE_GROUP_PERCENTILE = 20  # groups at or below this percentile of basket counts are pruned
MODEL_TYPE = "CVM"
MODEL_NAME = "CVM_v1.0"
TRAIN_PERIOD_DAYS = 180
PREDICT_PERIOD_DAYS = 14
DIVISIONS = ("LSG", "CCG")


class Preset(enum.Enum):
    """Values that the division decides."""

    DIVISION = "division"


def _parse_day(value: str | _dt.date) -> _dt.date:
    if isinstance(value, _dt.date):
        return value
    text = value.strip().replace("-", "")
    if len(text) != 8 or not text.isdigit():
        raise InputNotValidError(f"start_date must be YYYYMMDD or YYYY-MM-DD, got {value!r}")
    try:
        return _dt.date(int(text[:4]), int(text[4:6]), int(text[6:]))
    except ValueError as exc:
        raise InputNotValidError(f"start_date {value!r} is not a calendar day") from exc


def day_key(day: _dt.date) -> int:
    """Integer YYYYMMDD key of a calendar day."""
    return day.year * 10000 + day.month * 100 + day.day


def date_window(start_date: str | _dt.date, period_days: int) -> tuple[int, int]:
    """Half-open window ``[lo, hi)`` of YYYYMMDD keys.

    ``start_date`` is the exclusive end of a look-back window when ``period_days`` is
    negative (the usual case: ``period_days=-180`` is the 180 days before ``start_date``),
    and the inclusive start of a look-ahead window when it is positive.
    """
    if period_days == 0:
        raise InputNotValidError("period_days must not be 0")
    start = _parse_day(start_date)
    other = start + _dt.timedelta(days=period_days)
    lo, hi = (other, start) if period_days < 0 else (start, other)
    return day_key(lo), day_key(hi)


def shift_key(key: int, days: int) -> int:
    """Shift a YYYYMMDD key by a number of days."""
    return day_key(_parse_day(str(key)) + _dt.timedelta(days=days))


@dataclasses.dataclass(frozen=True)
class RunConfig:
    """Everything that changes between runs or divisions.

    ``division`` selects the preset rules: ``LSG`` drops discontinued SKUs from sales,
    keeps SKUs without a group in the sales (left join), cuts the ranked list at ``top_k``
    and publishes a pipe-joined list; ``CCG`` keeps every invoiced SKU, needs a group
    match (inner join), and publishes the ranked pairs without cut-off, also as files.
    """

    start_date: str
    period_days: int = -1
    division: str = "LSG"
    percentile_t: float = RARE_GROUP_PERCENTILE
    min_confidence: float = MIN_CONFIDENCE
    top_k: int | None | Preset = Preset.DIVISION  # LSG: 35, CCG: no cut-off; an explicit value wins
    max_groups_per_basket: int = MAX_GROUPS_PER_BASKET
    model_type: str = MODEL_TYPE
    model_name: str = MODEL_NAME
    train_period_days: int = TRAIN_PERIOD_DAYS
    predict_period_days: int = PREDICT_PERIOD_DAYS
    table_name: str = "recommendations"
    check_coverage: bool = True
    pair_method: str = "blocks"  # or "half" (pruned half pairs by a join), "join" (the original self-join)
    prune_candidates: bool = True  # rank per group before expanding to SKUs

    def __post_init__(self):
        if self.division not in DIVISIONS:
            raise InputNotValidError(f"Division {self.division!r} is not defined; use one of {DIVISIONS}")
        if not 0 <= self.percentile_t <= 100:
            raise InputNotValidError("percentile_t must be within [0, 100]")
        if self.pair_method not in ("blocks", "half", "join"):
            raise InputNotValidError("pair_method must be 'blocks', 'half' or 'join'")
        if self.top_k is Preset.DIVISION:
            object.__setattr__(self, "top_k", TOP_K if self.division == "LSG" else None)
        date_window(self.start_date, self.period_days)  # validates the date

    @classmethod
    def for_division(cls, division: str, **kwargs) -> "RunConfig":
        return cls(division=division, **kwargs)

    @property
    def window(self) -> tuple[int, int]:
        return date_window(self.start_date, self.period_days)

    @property
    def exclude_discontinued_sales(self) -> bool:
        return self.division == "LSG"

    @property
    def sales_group_join(self) -> str:
        return "left" if self.division == "LSG" else "inner"

    @property
    def publish_list(self) -> bool:
        return self.division == "LSG"
