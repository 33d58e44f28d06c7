"""Plain versions of the operators' definitions, and hard rows that every operator must survive."""

from __future__ import annotations

from collections import Counter

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, spans long"

LONG = " ".join(f"word{i % 977}" for i in range(30_000))
BASE = " ".join(f"w{i}" for i in range(120))

#: Nulls in any column, empty and very long texts, ties, repeated rows, clashing column names.
HARD = [
    (1, BASE, "en", "a", 1, "x", 1),
    (2, BASE.replace("w60", "other"), "en", "a", None, None, None),
    (3, BASE, None, None, 1, "x", 1),
    (4, None, "en", "a", 1, "x", 1),
    (5, "", "", "", 1, "x", 1),
    (6, " \t\n ", "de", "b", 1, "x", 1),
    (7, LONG, "en", "a", 1, "x", 1),
    (8, "one two", "en", "b", 1, "x", 1),
    (9, "One  TWO", "en", "b", 1, "x", 1),
    (1, BASE, "en", "a", 1, "x", 1),
    (None, BASE, "en", "a", 1, "x", 1),
    (10, "spam " * 200, "en", "a", 1, "x", 1),
    (11, "mail a.b@c.example.org or +1 (555) 555-0100 " + BASE, "en", "b", 1, "x", 1),
]


def hard_documents(spark):
    return spark.createDataFrame(HARD, DOCS)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)


def shingle_set(text: str | None, size: int) -> set:
    words = (text or "").encode().lower().split()
    if not words:
        return set()
    if len(words) < size:
        return {tuple(words)}
    return {tuple(words[i : i + size]) for i in range(len(words) - size + 1)}


def near_duplicate_rows(rows: list[tuple], size: int = 4) -> list[tuple]:
    """(doc_id, n_shingles, component_id, kept) by comparing every pair."""
    sets = {i: shingle_set(t, size) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in sets:
        for j in sets:
            both = len(sets[i] & sets[j])
            if i < j and both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((root(i), root(j)))
                parent[b] = a
    out = []
    for i, text in rows:
        component = root(i) if i is not None else None
        out.append((i, len(shingle_set(text, size)), component, i is None or i == component))
    return out


def quality_measures(text: str | None) -> tuple[int, int, int, int, int]:
    text = text or ""
    words, word = [], ""
    for c in text + " ":
        if c in " \t\n\x0b\x0c\r":
            if word:
                words.append(word)
            word = ""
        else:
            word += c
    lines = [line for line in text.split("\n") if line.strip(" \t\n\x0b\x0c\r")]
    windows = Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    inside = {
        j for i in range(len(words) - 2) if windows[tuple(words[i : i + 3])] > 1 for j in range(i, i + 3)
    }
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        sum(line in lines[:i] for i, line in enumerate(lines)), len(inside),
    )
