"""Run parameters."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from docmonitor import reference_data as ref


def _utc_now() -> dt.datetime:
    return dt.datetime.now(dt.timezone.utc).replace(tzinfo=None, microsecond=0)


@dataclass(frozen=True)
class RunParams:
    """What one monitoring run does.

    ``run_ts`` is fixed here, once, so no plan ever calls ``now()`` itself and a
    replayed run writes the same rows.  Dry runs are the default and write nothing.
    """

    project: str | int = ""
    run_name: str = "no name"
    run_id: str | None = None
    access_level: str = "private"
    from_year: int | None = None
    to_year: int | None = None
    upload_limit: int = 0
    dry_run: bool = True
    export_state: bool = False
    run_ts: dt.datetime = field(default_factory=_utc_now)
    authority: str = ref.DEFAULT_AUTHORITY
    category_local: str = ref.DEFAULT_CATEGORY_LOCAL
    scraper_name: str = "Document monitor"
    source_host: str = "docs.example.org"
    language: str = ref.LANGUAGE
    supported_extensions: tuple[str, ...] = ref.DEFAULT_EXTENSIONS

    def __post_init__(self) -> None:
        this_year = dt.date.today().year
        if self.from_year is None:
            object.__setattr__(self, "from_year", this_year)
        if self.to_year is None:
            object.__setattr__(self, "to_year", this_year)
        if self.access_level not in ref.ACCESS_LEVELS:
            raise ValueError(
                f"access_level must be one of {', '.join(ref.ACCESS_LEVELS)}; "
                f"got {self.access_level!r}"
            )
        if self.from_year > self.to_year:
            raise ValueError(f"empty year range: {self.from_year} to {self.to_year}")
        if self.upload_limit < 0:
            raise ValueError("upload_limit must be 0 (no limit) or more")

    @property
    def target_years(self) -> range:
        return range(self.from_year, self.to_year + 1)

    @property
    def year_label(self) -> str:
        """``"Y"`` for one year, else ``"Y1-Y2"`` (report titles)."""
        if self.from_year == self.to_year:
            return str(self.from_year)
        return f"{self.from_year}-{self.to_year}"

    @property
    def source_scraper(self) -> str:
        """Provenance label of every document; always carries both years."""
        return f"{self.scraper_name} {self.from_year}-{self.to_year}"

    @property
    def last_seen(self) -> str:
        return self.run_ts.isoformat(timespec="seconds")
