"""The models in plain Python over parsed records: what the fixtures should give."""

from __future__ import annotations

import datetime as dt
import glob
import hashlib
import json
from collections import defaultdict

STEPS = {"stream": ["page_view", "click", "add_to_cart", "purchase"],
         "batch_historical": ["page_view", "add_to_cart", "purchase"]}


def load(root: str) -> list[dict]:
    out = []
    for path in sorted(glob.glob(f"{root}/**/*.json*", recursive=True)):
        with open(path) as f:
            for r in map(json.loads, f):
                r["at"] = dt.datetime.fromisoformat(r["event_timestamp"].rstrip("Z"))
                r["day"] = r["at"].date()
                out.append(r)
    return out


def _minute(t: dt.datetime) -> dt.datetime:
    return t.replace(second=0, microsecond=0)


def _key(user: str | None, start: dt.datetime) -> str:
    text = start.strftime("%Y-%m-%d %H:%M:%S")
    if start.microsecond:
        text += f".{start.microsecond:06d}".rstrip("0")
    user = "_dbt_utils_surrogate_key_null_" if user is None else user
    return hashlib.md5(f"{user}-{text}+00".encode()).hexdigest()


def sessions(events: list[dict], gap: int = 30) -> list[list[dict]]:
    """Sessions as lists of events; every event gets ``sid``."""
    groups = defaultdict(list)
    for e in events:
        own = e["session_id"] if e["source"] == "stream" else e["user_id"]
        groups[(e["source"], own, e["user_id"])].append(e)
    out = []
    for (source, _, user), own in groups.items():
        own.sort(key=lambda e: (e["at"], e["event_id"]))
        part: list[dict] = []
        for e in own:
            if part and source != "stream" and _minute(e["at"]) - _minute(part[-1]["at"]) > dt.timedelta(minutes=gap):
                out.append(part)
                part = []
            part.append(e)
        out.append(part)
    for part in out:
        for e in part:
            e["sid"] = e["session_id"] if e["source"] == "stream" else _key(e["user_id"], part[0]["at"])
    return out


def in_fact(e: dict) -> bool:
    return e["source"] == "stream" or e["user_id"] is not None


def funnel(events: list[dict]) -> list[tuple]:
    out = []
    for source, steps in STEPS.items():
        n = [(k, t, len({e["sid"] for e in events if in_fact(e) and e["source"] == source and e["event_type"] == t}))
             for k, t in enumerate(steps, 1)]
        n = [x for x in n if x[2]]
        for i, (k, t, c) in enumerate(n):
            before = round(100 * c / n[i - 1][2], 2) if i else None
            out.append((source, k, t, c, round(100 * c / n[0][2], 2), before))
    return sorted(out)


def spine(events: list[dict]) -> list[tuple]:
    out = []
    for source in {e["source"] for e in events}:
        days = [e["day"] for e in events if e["source"] == source]
        out += [(source, min(days) + dt.timedelta(days=k)) for k in range((max(days) - min(days)).days + 1)]
    return sorted(out)


def active(events: list[dict]) -> list[tuple]:
    def users(source, day, n):
        return len({e["user_id"] for e in events if e["source"] == source and e["user_id"] is not None
                    and 0 <= (day - e["day"]).days < n})
    return [(s, d, users(s, d, 1), users(s, d, 7), users(s, d, 30)) for s, d in spine(events)]


def retention(events: list[dict]) -> list[tuple]:
    weeks = defaultdict(set)
    for e in events:
        if e["user_id"] is not None:
            weeks[(e["source"], e["user_id"])].add(e["day"] - dt.timedelta(days=e["day"].weekday()))
    cells = defaultdict(int)
    for (source, _), own in weeks.items():
        for w in own:
            cells[(source, min(own), (w - min(own)).days // 7)] += 1
    return sorted((s, c, k, cells[(s, c, 0)], n, round(100 * n / cells[(s, c, 0)], 2))
                  for (s, c, k), n in cells.items())
