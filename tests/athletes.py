"""A small athletes data set with awkward rows, and answers computed in plain Python."""

from __future__ import annotations

import math
import random
import struct as binary
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal
from fractions import Fraction

BIO_HEADER = ("athlete_id", "name", "sex", "height", "weight", "country_noc")
EVENT_HEADER = (
    "edition", "edition_id", "country_noc", "sport", "event", "result_id",
    "athlete", "athlete_id", "pos", "medal", "isTeamSport",
)


def bios(seed: int = 1, count: int = 60) -> list[tuple]:
    """Measures are text: numbers, ranges, empty cells and words."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        height = rng.choice([f"{rng.randint(1500, 2100) / 10}", "", "63-67", "180"])
        weight = rng.choice([f"{rng.randint(450, 1200) / 10}", "", "1,80", "-5"])
        rows.append((i, f"Müller, {i}", rng.choice(["Male", "Female"]), height, weight,
                     rng.choice(["USA", "FRA", "GER"])))
    return rows + rows[:7]


def events(seed: int = 2, count: int = 400) -> list[tuple]:
    """A third of the rows belong to one athlete; some athletes have no bio."""
    rng = random.Random(seed)
    rows = []
    for i in range(count):
        athlete = 3 if i % 3 == 0 else rng.randint(0, 70)
        rows.append((
            "2024 Summer", 1, rng.choice(["USA", "FRA", "GER", "ESP"]),
            rng.choice(["Rowing", "Ski Jump"]), f"E-{i % 5}", i, f"A {athlete}", athlete,
            str(rng.randint(1, 9)), rng.choice(["Gold", "Silver", ""]), rng.random() < 0.5,
        ))
    return rows + rows[:30]


def to_float32(x: float) -> float:
    return binary.unpack("f", binary.pack("f", x))[0]


def number(text: str | None) -> float | None:
    try:
        return float(text)
    except (TypeError, ValueError):
        return None


def cleaned(text: str | None) -> str:
    kept = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789,.\\\"'"
    return "".join(c for c in str(text) if c in kept)


def mean(values: list[float | None]) -> float | None:
    values = [v for v in values if v is not None]
    if not values:
        return None
    if any(math.isnan(v) for v in values):
        return math.nan
    exact = sum(map(Fraction, values)) / len(values)
    as_decimal = Decimal(repr(float(exact)))
    return float(as_decimal.quantize(Decimal("0.01"), ROUND_HALF_UP))


def averages(pairs: list[tuple[tuple, float | None, float | None]]) -> dict[tuple, tuple]:
    """Key to (mean height, mean weight)."""
    groups = defaultdict(lambda: ([], []))
    for key, height, weight in pairs:
        groups[key][0].append(height)
        groups[key][1].append(weight)
    return {k: (mean(h), mean(w)) for k, (h, w) in groups.items()}


def batch_answer(bio_rows: list[tuple], event_rows: list[tuple]) -> dict[tuple, tuple]:
    """Lake semantics: all text cleaned, equal rows once, measures narrowed, bio's country."""
    def clean_row(row: tuple) -> tuple:
        row = tuple(None if v == "" else v for v in row)
        return tuple(cleaned(v) if isinstance(v, str) or v is None else v for v in row)

    def measure(text: str) -> float | None:
        value = number(text)
        return None if value is None else to_float32(value)

    bio_set = {clean_row(r) for r in bio_rows}
    event_set = {clean_row(r) for r in event_rows}
    pairs = [
        ((e[3], e[9], b[2], b[5]), measure(b[3]), measure(b[4]))
        for e in event_set for b in bio_set if e[7] == b[0]
    ]
    return averages(pairs)


def stream_answer(bio_rows: list[tuple], event_rows: list[tuple]) -> dict[tuple, tuple]:
    """Stream semantics: nothing cleaned, copies count, bad bios dropped, event's country."""
    def usable(text: str | None) -> bool:
        value = number(text)
        return text is not None and not (value is not None and math.isnan(value))

    pairs = [
        ((e[3], e[9] or None, b[2], e[2]), number(b[3]), number(b[4]))
        for e in event_rows for b in bio_rows
        if e[7] == b[0] and usable(b[3] or None) and usable(b[4] or None)
    ]
    return averages(pairs)
