"""Small tables with the awkward rows every operator must take."""

from __future__ import annotations

import random

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, kept string"
LABELS = "doc_id long, quality int, toxic int"
_SYLLABLES = {"en": "the an er on th ing re at ed nd", "de": "sch ein ung ver keit ge en be ich au", "fr": "eau que ment tre oi ai elle pour les"}


def prose(rng: random.Random, words: int, lang: str = "en") -> str:
    parts = _SYLLABLES[lang].split()
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randint(1, 4))) for _ in range(words))


def documents(spark, texts, langs=None, sources=None, extra=()):
    """Rows with columns whose names operators use themselves."""
    rows = [
        (i, t, langs[i] if langs else "en", sources[i] if sources else f"s{i % 3}", len(t or ""), 9.0, "x")
        for i, t in enumerate(texts)
    ]
    return spark.createDataFrame(rows + list(extra), DOCS)
