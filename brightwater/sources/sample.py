"""A small set of plausible daily bars for trying things out: a seeded random walk on weekdays."""

from __future__ import annotations

import datetime
import random

#: Symbol, first price and daily deviation in percent.
SYMBOLS = (("AAA", 75.0, 1.8), ("BBB", 95.0, 2.0), ("CCC", 68.0, 1.6), ("DDD", 160.0, 1.7), ("EEE", 30.0, 3.5))


def weekdays(first: datetime.date, count: int) -> list[datetime.date]:
    out, day = [], first
    while len(out) < count:
        if day.weekday() < 5:
            out.append(day)
        day += datetime.timedelta(days=1)
    return out


def rows(first: datetime.date = datetime.date(2020, 1, 2), count: int = 100, seed: int = 42) -> list[dict[str, str]]:
    """``count`` bars of each symbol as raw text; they break no rule and no (Symbol, Date) comes twice."""
    draw, out = random.Random(seed), []
    for symbol, price, deviation in SYMBOLS:
        for day in weekdays(first, count):
            start, end = price, max(0.5, price * (1 + draw.gauss(0, deviation / 100)))
            high, low = max(start, end) * (1 + draw.random() / 100), min(start, end) * (1 - draw.random() / 100)
            prices = {k: f"{v:.4f}" for k, v in (("Open", start), ("High", high + 1e-3), ("Low", low - 1e-3), ("Close", end))}
            out.append({"Date": f"{day:%Y-%m-%d}", "Symbol": symbol, **prices, "Volume": str(draw.randrange(10**6, 10**8)), "OpenInt": "0"})
            price = end
    return out
