"""Cut-off days: where features stop and the label window starts."""

import datetime as dt
from dataclasses import dataclass

from buycast.functions.times import as_date, month_window


@dataclass(frozen=True)
class Cutoff:
    """Features use days up to ``day``; ``split`` names the table; test splits carry no label."""
    split: str
    day: dt.date
    has_label: bool = True


def cutoff(split, day, has_label=True) -> Cutoff:
    return Cutoff(split, as_date(day), has_label)


def rolling_splits(train="2013-06-30", validation="2013-07-31", test="2013-08-31"):
    """One cut-off per split; the test split has no label yet."""
    return [cutoff("train", train), cutoff("validation", validation), cutoff("test", test, False)]


def slots(first="2013-07-01", n=4, step_days=7):
    """Weekly training slots. A slot date B uses days before B, so its cut-off is B - 1."""
    first = as_date(first)
    return [
        cutoff(f"slot{i}", first + dt.timedelta(days=step_days * i - 1)) for i in range(n)
    ]


def label_end(day, rule):
    """Last day of the label window after ``day``; None where it is open."""
    if rule == "month":
        return month_window(day)[1]
    if rule == "goods30":
        return as_date(day) + dt.timedelta(days=30)
    if rule == "open":
        return None
    raise NotImplementedError(f"unknown label rule {rule!r}")
