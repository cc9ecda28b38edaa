"""Rows that cover NULLs, empty and long texts, ties, repeated rows and odd ids."""

from __future__ import annotations

import random


def edge_rows() -> list[tuple]:
    r = random.Random(7)
    words = ["alpha", "Beta,", "gamma", "delta", "épsilon", "zeta", "漢字", "eta.", "theta", "idiot"]
    base = [r.choice(words) for _ in range(160)]
    rows = []
    for i in range(60):
        own = [r.choice(words) for _ in range(r.randint(1, 80))]
        rows.append((i, " ".join(own), "en", r.choice(["a", "b", "c", "ü"]), 1))
    for i in range(60, 72):  # near copies: one word changed
        own = list(base)
        own[r.randrange(160)] = f"changed{i}"
        rows.append((i, " ".join(own), None, "b", None))
    for i in range(72, 80):  # exact copies, up to white space
        rows.append((i, ("\n" * (i % 3)).join(base[:30]) + " " * (i % 4), "en", None, 2))
    rows += [
        (80, None, None, None, None), (81, "", "en", "a", 0), (82, " \t\n\r\x0b\x0c ", "en", "a", 7),
        (83, "x" * 200_000, "en", "a", 1), (84, "word " * 30_000, "en", "c", 1),
        (None, "a row without id", "en", "a", 1), (None, "a row without id", "en", "a", 1),
        (None, None, None, None, None), (85, "same same", "en", "a", 1), (85, "same same", "en", "a", 1),
        (-3, "negative id", "en", "a", 1), (86, "AKIA and \x00 nul", "en", "", 1), (87, "😀 " * 40, "en", "c", 3),
        (88, "one two three four", "en", "c", 3), (89, "one two three four", "fr", "b", 3),
    ]
    return rows
