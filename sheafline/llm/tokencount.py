"""Token counts per section from one encoding of the whole document.

A document is encoded once; its tokens' character spans are joined to the sections' spans (both sorted, so the interval
join is a binary search per token), and each section gets the number of its tokens. A token whose span crosses a border
is given by ``rule``: ``first`` to the section of its first character, ``last`` to that of its last character, ``most`` to
the section that holds most of its bytes (the earlier one at a tie). Tokens outside every section count as ``section`` null.

A token can begin or end inside a character of several bytes; its span is then that character.

Defined results: a null or empty text has no tokens, and its sections count 0; sections must not overlap; empty sections
hold nothing; repeated documents are counted each.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import SLICE, encoder, ids_of
from .common import add_text_columns

COUNTED = T.ArrayType(T.StructType([T.StructField("section", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("n_crossing", T.LongType())]))


def line_sections(text: str) -> list[tuple[str, int, int]]:
    """Sections of a plain document: its first line as ``title`` and the rest as ``body``; the line break belongs to the title."""
    cut = text.find("\n") + 1 or len(text)
    return [("title", 0, cut), ("body", cut, len(text))]


def attribute(text: str, ids: np.ndarray, length: np.ndarray, sections: list[tuple[str, int, int]], rule: str = "first") -> list[dict]:
    """Sections with their counts; character spans (start, end) of ``sections`` may leave gaps but not overlap."""
    ends = np.cumsum(length[ids])
    starts = np.concatenate([[0], ends[:-1]]) if len(ids) else ends
    data = np.frombuffer(text.encode(), np.uint8)
    lead = (data & 0xC0) != 0x80
    char_of = np.cumsum(lead) - 1  # of each byte
    byte_of = np.concatenate([np.flatnonzero(lead), [len(data)]])
    order = sorted(range(len(sections)), key=lambda k: (sections[k][1], sections[k][2]))
    kept = [k for k in order if sections[k][2] > sections[k][1]]
    lows, highs = np.array([sections[k][1] for k in kept], np.int64), np.array([sections[k][2] for k in kept], np.int64)

    def of(chars: np.ndarray) -> np.ndarray:
        """Index into ``kept`` of the section of each character, -1 for none."""
        at = np.searchsorted(lows, chars, "right") - 1
        return np.where((at >= 0) & (chars < highs[np.maximum(at, 0)]), at, -1) if len(kept) else np.full(len(chars), -1)

    if len(ids):
        first, last = of(char_of[starts]), of(char_of[ends - 1])
        crossing = first != last
        home = first if rule == "first" else last if rule == "last" else first.copy()
        if rule == "most":
            for i in np.flatnonzero(crossing):  # few: only those at a border
                held = of(char_of[starts[i] : ends[i]])
                found, at, n = np.unique(held, return_index=True, return_counts=True)
                home[i] = found[np.lexsort((at, -n))[0]]
    else:
        home = crossing = np.zeros(0, np.int64)
    counts = np.bincount(home + 1, minlength=len(kept) + 1)
    crossed = np.bincount(home + 1, weights=crossing, minlength=len(kept) + 1)
    place = {k: i + 1 for i, k in enumerate(kept)}
    out = [{"section": s, "start": a, "end": b, "n_tokens": int(counts[place[k]]) if k in place else 0, "n_crossing": int(crossed[place[k]]) if k in place else 0} for k, (s, a, b) in enumerate(sections)]
    if counts[0]:
        out.append({"section": None, "start": None, "end": None, "n_tokens": int(counts[0]), "n_crossing": int(crossed[0])})
    return out


def count_sections(df: DataFrame, path: str, pattern: str, text: str = "text", rule: str = "first", sections=line_sections) -> DataFrame:
    """Replace the text by ``sections``: array of (section, start, end, n_tokens, n_crossing). ``sections(text)`` gives (name, start, end)s."""
    if rule not in ("first", "last", "most"):
        raise ValueError(f"no such rule: {rule}")

    def make():
        enc = encoder(path, pattern)

        def run(texts: list) -> dict:
            return {"sections": [attribute(t or "", ids_of(j), enc.fst.length, sections(t or ""), rule) for t, j in zip(texts, enc.joined([t or "" for t in texts]))]}

        return run

    return add_text_columns(df, text, [T.StructField("sections", COUNTED)], make, SLICE, keep_text=False, keeps=True)
