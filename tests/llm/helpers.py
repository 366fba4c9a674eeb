"""Small tables with everything a table can have, and plain versions of what operators do."""

from __future__ import annotations

import random
import re

LONG = "lorem ipsum dolor sit amet " * 4000


def prose(rng: random.Random, n: int, vocabulary: int = 3000) -> str:
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


def odd_rows(rng: random.Random) -> list[tuple]:
    """(doc_id, text, lang, source): nulls in every column, empty and blank texts, a very long one,
    ties and repeated rows."""
    text = prose(rng, 80)
    return [
        (1, text, "en", "a"),
        (1, text, "en", "a"),
        (2, text, "en", "a"),
        (3, text.upper(), None, None),
        (4, None, "en", "b"),
        (5, "", "de", "b"),
        (6, " \t\n ", "de", None),
        (7, LONG, "en", "a"),
        (None, prose(rng, 60), "en", "c"),
        (None, None, None, None),
        (8, "one two", "fr", "c"),
        (9, "one two", "fr", "c"),
        (10, "Ünï cödé 中文 \U0001f600 words", "fr", "c"),
        (11, "... --- !!!", "fr", "c"),
    ]


SCHEMA = "doc_id long, text string, lang string, source string"


def spaced(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lower)


def alnum(text: str | None) -> list[str]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)
