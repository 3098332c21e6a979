"""Domain, variable and correction settings, passed to operators as plain values."""

from __future__ import annotations

from dataclasses import dataclass, replace


@dataclass(frozen=True)
class CorrectionParams:
    """How one variable is bias-corrected.

    ``low_extrapol`` and ``up_extrapol`` are one of ``constant``, ``delta_additive``,
    ``delta_scaling`` and ``distribution``. ``window`` is the half width of the reference
    calendar window, ``mdl_window`` that of the hindcast lead window, both in days.
    """

    dry_thresh: float = 0.01
    low_extrapol: str = "delta_additive"
    up_extrapol: str = "delta_additive"
    extremes: str = "weibull"
    intermittency: bool = True
    nquants: int = 2500
    window: int = 15
    mdl_window: int = 15
    fill_tied_max: bool = False

    def __post_init__(self):
        known = ("constant", "delta_additive", "delta_scaling", "distribution")
        for tail in (self.low_extrapol, self.up_extrapol):
            if tail not in known:
                raise ValueError(f"unknown tail rule {tail!r}, expected one of {known}")


@dataclass(frozen=True)
class Variable:
    name: str
    units: str
    dtype: str
    scale: float
    offset: float
    precip: bool = False
    fill: int = -9999


@dataclass(frozen=True)
class Domain:
    """``bbox`` is (lon_min, lon_max, lat_min, lat_max)."""

    name: str
    bbox: tuple[float, float, float, float]
    variables: tuple[str, ...]
    res: float = 0.1
    syr: int = 1981
    eyr: int = 2016
    params: CorrectionParams = CorrectionParams()


# Packing of each variable.
VARIABLES = {
    v.name: v
    for v in (
        Variable("tp", "mm/day", "int", 0.01, 0.0, precip=True),
        Variable("t2m", "K", "smallint", 0.01, 273.15),
        Variable("t2min", "K", "smallint", 0.01, 273.15),
        Variable("t2max", "K", "smallint", 0.01, 273.15),
        Variable("t2plus", "K", "smallint", 0.01, 0.0),
        Variable("t2minus", "K", "smallint", 0.01, 0.0),
        Variable("ssrd", "W m-2", "int", 0.01, 0.0),
        Variable("rh", "1", "int", 0.0001, 0.0),
    )
}

# Regions and their calibration years.
DOMAINS = {
    d.name: d
    for d in (
        Domain("khuzestan", (45, 53.5, 29, 36), ("tp", "t2m")),
        Domain("ceara", (-41.6, -37.0, -8, -2.7), ("tp", "t2m", "ssrd")),
        Domain(
            "germany",
            (5.25, 15.15, 45.55, 55.45),
            ("tp", "t2m"),
            params=replace(CorrectionParams(), dry_thresh=0.1),
        ),
        Domain("west_africa", (-12.9, 16.9, 3.2, 24.9), ("tp",)),
        Domain("west_africa_test", (0, 6, 10, 15), ("t2minus",), eyr=1982),
        Domain("chira_test", (-82, -78, -7, -2), ("tp",)),
    )
}

# Names used by the source archives.
RENAMES = {
    "longitude": "lon",
    "latitude": "lat",
    "var228": "tp",
    "var55": "mean2t24",
    "var52": "mn2t24",
    "var51": "mx2t24",
    "var169": "ssrd",
}
DAILY_NAMES = {"mean2t24": "t2m", "mn2t24": "t2min", "mx2t24": "t2max"}

LEADS = 215  # forecast days per issue
RAW_MEMBERS = 51  # members interleaved on the raw time axis


def members_in(year: int) -> int:
    """Ensemble size of an issue year."""
    return 25 if year < 2017 else 51
