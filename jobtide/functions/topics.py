"""Topic patterns: dot-separated words, ``*`` for one word, ``#`` for any number of words."""

from __future__ import annotations

import re

_WORD = r"[^.]+"


def topic_regex(pattern: str) -> str:
    """Anchored regular expression of a topic pattern.

    A run of ``#`` means the same as one.  The dot next to a ``#`` is optional together with
    the words, so that ``a.#`` also fits ``a``.
    """
    words: list[str] = []
    for word in pattern.split("."):
        if word != "#" or not words or words[-1] != "#":
            words.append(word)
    if words == ["#"]:
        return rf"^(?:{_WORD}(?:\.{_WORD})*)?$"
    out = ""
    need_dot = False
    for position, word in enumerate(words):
        if word == "#":
            if position == 0:
                out += rf"(?:{_WORD}\.)*"
            else:
                out += rf"(?:\.{_WORD})*"
                need_dot = True
            continue
        if need_dot:
            out += r"\."
        out += _WORD if word == "*" else re.sub(r"([^A-Za-z0-9_])", r"\\\1", word)
        need_dot = True
    return f"^{out}$"
