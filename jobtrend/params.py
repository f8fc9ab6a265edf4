"""Report parameters in one place."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

# Fixed values that must equal the reference job for equal results:
# states left out of the regional slices, the anchor industry and size
# threshold of the area cohorts, the trailing "year to date" length, the
# data type of employment counts, and the area-name markers.
REFERENCE_EXCLUDED_STATES = ("District of Columbia", "Virgin Islands", "Puerto Rico")
REFERENCE_ANCHOR_INDUSTRY = "Total Nonfarm"
REFERENCE_THRESHOLD = 1000.0
REFERENCE_YTD_MONTHS = 5
EMPLOYMENT_DATA_TYPE = "01"
STATEWIDE = "Statewide"
UNITED_STATES = "United States"
SUBAREA_MARKERS = ("Metropolitan Division", "NECTA Division")
AREA_NAME_REMOVALS = (" NECTA", "Metropolitan Statistical Area")
ANNUAL_MONTHS = 12
ANNUAL_AVERAGE_PERIOD = "M13"


@dataclass(frozen=True)
class ReportParams:
    """Knobs of every report.

    ytd_months      length of the trailing "year to date" mean (WIN1).
    ytd_mode        "trailing": mean of the last ``ytd_months`` rows (reference);
                    "calendar": running mean of the months of the same year.
    scope           "series": windows run inside one series (region, supersector,
                    industry); "table": windows run down the whole sorted table,
                    crossing series boundaries as the reference does.
    calendar        False: lags count rows (reference); True: lags count months,
                    so a missing month yields no base instead of an older one.
    threshold       size cut of the area cohorts, applied to raw rows.
    anchor_industry industry whose rows decide cohort membership.
    excluded_states states left out of the regional slices.
    tidy_names      also trim the space left by removing area-name suffixes.
    data_type_code  national slices: optional data type filter (the reference has none).
    bucket_rows     table scope only: rows per window bucket (each bucket is one task).
    """

    ytd_months: int = REFERENCE_YTD_MONTHS
    ytd_mode: str = "trailing"
    scope: str = "series"
    calendar: bool = False
    threshold: float = REFERENCE_THRESHOLD
    anchor_industry: str = REFERENCE_ANCHOR_INDUSTRY
    excluded_states: tuple[str, ...] = field(default=REFERENCE_EXCLUDED_STATES)
    tidy_names: bool = False
    data_type_code: str | None = None
    bucket_rows: int = 65536

    def with_(self, **changes) -> "ReportParams":
        return replace(self, **changes)

    def __post_init__(self) -> None:
        if self.ytd_mode not in ("trailing", "calendar"):
            raise ValueError(f"ytd_mode must be 'trailing' or 'calendar', got {self.ytd_mode!r}")
        if self.scope not in ("series", "table"):
            raise ValueError(f"scope must be 'series' or 'table', got {self.scope!r}")
        if self.ytd_months < 1:
            raise ValueError("ytd_months must be positive")
        if self.bucket_rows < 1:
            raise ValueError("bucket_rows must be positive")
