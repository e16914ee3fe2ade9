"""Typed configuration; replaces YAML files and command-line flags."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field


@dataclass(frozen=True)
class EventsConfig:
    """Options of the GA4 events preparation (T1 -> T3)."""

    # Scan only shards whose ``event_date`` (yyyyMMdd string) is >= start_date.
    start_date: str = "20230101"
    # 'medium' reproduces the shipped behaviour (campaign_name = lower(manual_medium));
    # 'campaign' reads collected_traffic_source.manual_campaign_name instead.
    campaign_from: str = "medium"
    # Duplicate event_params keys: False takes the first match, True raises at runtime.
    strict_params: bool = False
    # Broadcast the source-category dimension only below this many rows.
    broadcast_max_rows: int = 100_000

    def __post_init__(self):
        if self.campaign_from not in ("medium", "campaign"):
            raise ValueError("campaign_from must be 'medium' or 'campaign'")


@dataclass(frozen=True)
class WindowConfig:
    """Conversion and lookback windows of the chains-base preparation (T3 -> T4)."""

    # The day of the run: windows end with the month before it. No default, as a
    # wrong day silently keeps other sessions.
    as_of: dt.date
    conversion_period: int = 30
    lookback_window: int = 90

    def __post_init__(self):
        if self.lookback_window < 1 or self.conversion_period < 0:
            raise ValueError("lookback_window must be >= 1 and conversion_period >= 0")

    @property
    def last_day(self) -> dt.date:
        """Last day of the month before ``as_of``."""
        return self.as_of.replace(day=1) - dt.timedelta(days=1)

    @property
    def conversion_start(self) -> dt.date:
        return self.last_day - dt.timedelta(days=self.conversion_period)

    @property
    def candidate_start(self) -> dt.date:
        return self.last_day - dt.timedelta(days=self.conversion_period + self.lookback_window)


@dataclass(frozen=True)
class ChainConfig:
    """Chain building and attribution options (T4 -> T8)."""

    # Stamped on the results.
    run_date: dt.date
    merge_gap_days: int = 3
    concat_within_days: int = 10
    concat_chains: bool = True
    # 'raw' reproduces the shipped driver (concatenation of unmerged chains);
    # 'merged' concatenates the merged chains instead.
    concat_input: str = "raw"
    # 'raise' stops a run on a violated check (Q1-Q6), 'report' goes on.
    on_violation: str = "raise"

    @property
    def window_days(self) -> int:
        """Days whose chains stand in front of a conversion's own; 0 without concatenation."""
        return self.concat_within_days if self.concat_chains else 0

    @property
    def merges(self) -> bool:
        """Whether the final chains are made from merged ones."""
        return not self.concat_chains or self.concat_input == "merged"

    def __post_init__(self):
        if self.on_violation not in ("raise", "report"):
            raise ValueError("on_violation must be 'raise' or 'report'")
        if self.concat_input not in ("raw", "merged"):
            raise ValueError("concat_input must be 'raw' or 'merged'")


@dataclass(frozen=True)
class MediaChannel:
    """One recap sheet: columns are ``<prefix>_<subchannel>_<split>``."""

    name: str
    prefix: str
    subchannels: tuple[str, ...]
    splits: tuple[str, ...]


@dataclass(frozen=True)
class MediaConfig:
    """Weekly media recap configuration."""

    perimeter: tuple[dt.date, dt.date]
    # Ordered (label, start, end) ranges, inclusive; first match wins.
    years: tuple[tuple[str, dt.date, dt.date], ...]
    channels: tuple[MediaChannel, ...] = field(default_factory=tuple)
    date_col: str = "week_end_date"

    @property
    def csv_columns(self) -> list[str]:
        """The date and the columns of all channels, in order of the channels."""
        return [self.date_col, *[f"{c.prefix}_{sub}_{split}" for c in self.channels for sub in c.subchannels for split in c.splits]]
