"""Definitions that the operators are compared with."""

import re

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text, width, pattern=SPACED):
    """The set of word shingles by definition."""
    words = pattern.findall(lowered(text))
    if len(words) < width:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + width]) for i in range(len(words) - width + 1)}
