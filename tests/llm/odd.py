"""Texts that every text operator has to take."""

from __future__ import annotations

import random

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, size int, kept string"


def words(rng: random.Random, n: int, vocabulary: int = 400) -> list[str]:
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def odd_texts(rng: random.Random) -> list[str | None]:
    line = " ".join(words(rng, 30))
    return [
        None, "", " \n\t ", "one", "two words", line, line, f" {line}\n", line.replace(" ", "  "), line.upper(),
        "\n".join([line] * 6), "ü ß é 漢字 " * 30, "#*$% <|> " * 20, "a b c\u0085d e\x1cf",
        " ".join(words(rng, 6000)),
    ]
