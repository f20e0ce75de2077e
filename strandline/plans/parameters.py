"""Parameters: relative times, durations, date ranges, sampling methods, settings laid over each other, job names."""

from __future__ import annotations

import re
from dataclasses import dataclass, field, fields, replace
from datetime import datetime, timedelta
from typing import Any

METHODS = {"telegram": ("channel", "snowball", "random-walk"), "youtube": ("channel", "random", "snowball")}
WORK_MODES = ("", "standalone", "orchestrator", "worker", "job")


def relative_time(text: str, now: datetime) -> datetime:
    """now less '6h', '30d', '2w', '1m' or '1y'. Months and years are of the calendar; a day past a month's end runs over
    into the next month, so a month before 31 March is 3 March (2 in leap years)."""
    found = re.fullmatch(r"(\d+)([hdwmy])", text.strip())
    if not found:
        raise ValueError(f"not a time like 30d, 6h, 2w, 1m or 1y: {text!r}")
    n, unit = int(found[1]), found[2]
    if unit in "hdw":
        return now - {"h": timedelta(hours=n), "d": timedelta(days=n), "w": timedelta(weeks=n)}[unit]
    month = now.year * 12 + now.month - 1 - n * (12 if unit == "y" else 1)
    return now.replace(year=month // 12, month=month % 12 + 1, day=1) + timedelta(days=now.day - 1)


def duration(text: str) -> timedelta:
    """'48h30m' and the like."""
    units = {"h": 3600, "m": 60, "s": 1, "ms": 0.001, "us": 1e-6, "ns": 1e-9}
    parts = re.findall(r"(\d+(?:\.\d+)?)(ms|us|ns|h|m|s)", text)
    if not parts or "".join(a + b for a, b in parts) != text:
        raise ValueError(f"not a duration like 48h30m: {text!r}")
    return timedelta(seconds=sum(float(a) * units[b] for a, b in parts))


def date_range(text: str) -> tuple[datetime, datetime]:
    """Two dates, 'Y-M-D,Y-M-D', the earlier first."""
    parts = text.split(",")
    if len(parts) != 2:
        raise ValueError("expected two dates with a comma between")
    low, high = (datetime.strptime(p.strip(), "%Y-%m-%d") for p in parts)
    if low > high:
        raise ValueError("the first date is after the second")
    return low, high


def date_window(now: datetime, between: tuple[datetime | None, datetime | None] = (None, None), recency: datetime | None = None, min_date: datetime | None = None) -> tuple[datetime | None, datetime]:
    """Bounds of a scan: a whole range goes before recency, and that before a first date; the last bound is now by default."""
    if between[0] and between[1]:
        return between[0], between[1]
    return recency or min_date, now


def validate_sampling(platform: str, method: str, urls: int = 0, url_file: bool = False, sample_size: int = 0, seed_size: int = 0, crawl_id: str = "") -> None:
    """An error unless the platform has the method and the method its inputs."""
    if platform not in METHODS:
        raise ValueError(f"unsupported platform: {platform}")
    if method not in METHODS[platform]:
        raise ValueError(f"{platform} doesn't support the sampling method {method}; it has {', '.join(METHODS[platform])}")
    given = bool(urls or url_file)
    if method in ("channel", "snowball") and not given:
        raise ValueError(f"{method} sampling needs channels")
    if method == "random" and (given or sample_size <= 0):
        raise ValueError("random sampling needs a sample size and takes no channels")
    if method == "random-walk":
        if given == bool(seed_size):
            raise ValueError("a random walk needs either channels or a seed size")
        if not crawl_id:
            raise ValueError("a random walk needs a crawl id")


@dataclass(frozen=True)
class CrawlSettings:
    platform: str = "telegram"
    sampling_method: str = "channel"
    crawl_label: str = ""
    concurrency: int = 1
    max_depth: int = -1
    max_posts: int = -1
    max_comments: int = -1
    max_pages: int = 108_000
    min_users: int = 100
    min_channel_videos: int = 10
    sample_size: int = 0
    seed_size: int = 0
    walkback_rate: int = 15
    validator_claim_size: int = 10
    trigger_bytes: int = 170 << 20
    hard_cap_bytes: int = 200 << 20
    min_post_date: datetime | None = None
    extra: dict[str, Any] = field(default_factory=dict)

    def overlaid(self, job: dict[str, Any]) -> CrawlSettings:
        """These settings with those of a job that aren't zero or empty put over them; unknown ones are an error."""
        known = {f.name for f in fields(self)}
        if set(job) - known:
            raise ValueError(f"unknown settings: {', '.join(sorted(set(job) - known))}")
        return replace(self, **{k: v for k, v in job.items() if v})


def validate_mode(mode: str, worker_id: str = "", trigger: int = 170, cap: int = 200) -> None:
    if mode not in WORK_MODES:
        raise ValueError(f"unknown mode: {mode}")
    if mode == "worker" and not worker_id:
        raise ValueError("a worker needs an id")
    if trigger <= 0 or cap < trigger:
        raise ValueError("the hard cap must be at least the trigger, which must be over 0")


JOBS = ("scheduled-crawl", "crawl", "maintenance")


def job_kind(name: str, task: str = "") -> str:
    """The kind of a job by its name, which may go on after a hyphen; else a task that mentions crawl is one."""
    for kind in JOBS:
        if re.fullmatch(rf"{kind}(-.*)?", name, re.S):
            return "crawl" if kind.endswith("crawl") else kind
    return "crawl" if "crawl" in task.lower() else "generic"


def batch_size(remaining: int, rate: float, least: int = 5, most: int = 50) -> int:
    """How many to ask for at once when a share `rate` of them is of use."""
    wanted = remaining if rate <= 0 else int(remaining / rate) + 1
    return max(least, min(most, wanted))


def quota_rounds(found: list[int], target: int) -> tuple[int, int]:
    """Rounds and posts of a loop that samples min(50, remaining) each time, with found[k] of them of use, until the target
    or 100 rounds for each wanted and 100 more."""
    have = rounds = 0
    for n in found:
        if have >= target or rounds >= 100 * target + 100:
            break
        rounds, have = rounds + 1, have + min(n, 50, target - have)
    return rounds, have
