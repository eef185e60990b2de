"""Small tables with every awkward case, and brute-force versions to compare with."""

from __future__ import annotations

import re
from collections import defaultdict

WORDS = "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi rho".split()


def prose(seed: int, n: int) -> str:
    return " ".join(f"{WORDS[(seed * 7 + i * i) % len(WORDS)]}{(seed * 31 + i * 17) % 97}" for i in range(n))


#: Null ids and texts, empty and very long texts, repeated rows, equal ids with unequal texts.
AWKWARD = [
    (1, "one two three"),
    (1, "one two three"),
    (1, "another text of the same id"),
    (None, "a text without an id"),
    (None, None),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (5, "x" * 20_000),
    (6, prose(1, 4_000)),
    (7, "Ünïcödé 日本語 🙂 <|endoftext|> don't  stop\r\n\x85 end "),
]
SCHEMA = "doc_id bigint, text string"


def clashing(df):
    """The table with columns that operators use for themselves."""
    from pyspark.sql import functions as F

    extra = ("n_tokens", "hash", "n", "label", "words", "item", "length", "k1", "id_hash", "is_good")
    return df.withColumns({name: F.lit("other") for name in extra})


def shingles(text: str | None) -> frozenset:
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def linked_components(rows: list[tuple]) -> dict:
    """Smallest id that links reach, by position, from all pairs."""
    sets = [shingles(text) for _, text in rows]
    parent = list(range(len(rows)))

    def root(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[root(i)] = root(j)
    members = defaultdict(list)
    for i in range(len(rows)):
        members[root(i)].append(i)
    out = {}
    for own in members.values():
        ids = [rows[i][0] for i in own if rows[i][0] is not None]
        for i in own:
            out[i] = (len(sets[i]), min(ids) if ids else None)
    return out


def hit_words(text: str | None, items: list[tuple], window: int = 13) -> tuple:
    """n_words, n_hit and the ids of items with an occurring window."""
    cut = lambda t: re.findall(
        r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+",
        "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""),
    )
    words, hit, found = cut(text), set(), set()
    for name, body in items:
        own = cut(body)
        size = min(window, len(own))
        if not own or name is None:
            continue
        windows = {tuple(own[i : i + size]) for i in range(len(own) - size + 1)}
        for p in range(len(words) - size + 1):
            if tuple(words[p : p + size]) in windows:
                hit.update(range(p, p + size))
                found.add(str(name))
    return len(words), len(hit), sorted(found)
