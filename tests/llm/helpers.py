"""Frames with all odd cases, and plain restatements of what operators promise."""

from __future__ import annotations

import re
import string

LOWER = str.maketrans(string.ascii_uppercase, string.ascii_lowercase)
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
#: Columns with names that operators use inside.
CLASHING = "doc_id long, text string, lang string, source string, n_chars long, row string, found string, node long, own string, mark int, body string, key string, `a.b` string"


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(LOWER))


def prose(seed: int, n: int) -> str:
    """n different words without meaning."""
    return " ".join(f"w{seed}x{(i * 7919 + seed * 104729) % 100003}" for i in range(n))


def odd_documents(spark, texts):
    """(doc_id, text) pairs with clashing extra columns."""
    rows = [(k, t, "en", "s", len(t or ""), "r", "f", 1, "o", 2, "b", "k", "ab") for k, t in texts]
    return spark.createDataFrame(rows, CLASHING)
