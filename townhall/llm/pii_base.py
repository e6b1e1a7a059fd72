"""Exact patterns for personal data: leftmost, non-overlapping for each kind."""

from __future__ import annotations

import re
from collections.abc import Iterator

KINDS = ("email", "ip", "card", "phone")

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# a match never ends inside a run of digits, so one can only begin where a run does
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
MAYBE = re.compile(r"[0-9@]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Each address has one ``@``; its local part reaches back to the end of the match before."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        match = _DOMAIN.match(text, at + 1) if start < at else None
        if match:
            yield start, match.end()
            done = match.end()
        at = text.find("@", max(at + 1, done))


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.group().split(".") if p.strip("0")):
            yield m.span()


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m.group().replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 8 <= len(_DIGIT.findall(m.group())) <= 15:
            yield m.span()


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) by kind, then start."""
    if not MAYBE.search(text):
        return []
    finders = (emails, ips, cards, phones)
    return [(k, a, b) for k, find in enumerate(finders) for a, b in find(text)]


def written(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(spans))
