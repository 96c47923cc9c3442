"""Secret scan: patterns of known kinds, and windows of high Shannon entropy in candidate strings.

A candidate is a run of at least ``WINDOW`` characters of keys and tokens. A window slides over it; the counts
of its characters, and with them its entropy, are updated by one character in and one out. Each class of
characters has its own threshold, as the entropy that chance gives depends on the alphabet. Windows that overlap a known
harmless part are passed over, and so are those near a harmless word in the same piece of the candidate.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from functools import lru_cache
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from farelight.llm import words
from farelight.llm.tables import batch_map, documents

# The patterns of the known kinds and their shortest matches.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ASSIGN_KEYS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
SHORTEST = {"assign": 8, "access": 16, "hex": 32}
KINDS = ("assign", "access", "hex", "entropy")

#: Characters of a window, and bits per character it needs, by class of the candidate.
WINDOW = 20
THRESHOLDS = {"hex": 3.0, "mixed": 3.6, "letters": 3.62, "digits": 2.8}

#: Classes whose windows may not reach over a separator: names made of words are as varied as chance.
WHOLE_PIECES = ("letters", "digits")

#: Windows that overlap one of these parts, in lower case, are no secrets.
ALLOWED = (
    "example", "placeholder", "changeme", "your_", "your-", "dummy", "sample", "xxxx", "0123456789", "1234567890",
    "abcdefgh", "====", "----", "____", "++++", "////",
)

#: Those that are words say the same of the windows up to ``WINDOW`` characters from them in their piece. Pieces end at these separators.
ALLOWED_WORDS = ("example", "placeholder", "changeme", "dummy", "sample")
SEPARATORS = "=/_-"
_PIECE = re.compile(f"[^{re.escape(SEPARATORS)}]+")

_HEX = np.zeros(256, dtype=bool)
_HEX[[ord(c) for c in "0123456789abcdef"]] = True
_TOKEN = np.zeros(256, dtype=bool)
_TOKEN[[ord(c) for c in "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"]] = True
_HEX_RUNS = (re.compile("[0-9a-f]+"), re.compile("[0-9A-F]+"))
_WEIGHT = [0.0] + [n * log2(n) for n in range(1, WINDOW + 1)]


def character_class(text: str) -> str | None:
    """hex: digits and letters a to f of one case; mixed: letters and digits, or both cases; letters; digits; or none."""
    digits = any(c.isdigit() for c in text)
    letters = [c for c in text if c.isalpha()]
    if not letters:
        return "digits" if digits else None
    one_case = all(c.islower() for c in letters) or all(c.isupper() for c in letters)
    if digits and one_case and all(c in "abcdefABCDEF" for c in letters) and len(letters) + sum(c.isdigit() for c in text) == len(text):
        return "hex"
    inner = any(c.isupper() for c in letters[1:]) and any(c.islower() for c in letters)
    return "mixed" if digits or inner else "letters"


@lru_cache(maxsize=8)
def _parts(allowed: tuple[str, ...]) -> re.Pattern:
    # A look ahead, as parts may overlap.
    return re.compile("(?=(" + "|".join(map(re.escape, allowed)) + "))")


def blocked_windows(text: str, window: int = WINDOW, allowed=ALLOWED) -> bytearray | None:
    """Per start of a window, whether an allowed part rules it out; None if none does."""
    low = text.lower()
    if not any(a in low for a in allowed):
        return None
    starts = len(text) - window + 1
    out = bytearray(starts)
    pieces = None
    until = 0
    for m in _parts(tuple(allowed)).finditer(low):
        begin, end = m.start(1), m.end(1)
        first, last = max(begin - window + 1, 0, until), min(end, starts)
        if first < last:
            out[first:last] = b"\1" * (last - first)
            until = last
        if m[1] in ALLOWED_WORDS:
            if pieces is None:
                pieces = [p.span() for p in _PIECE.finditer(low)]
                edges = [p[0] for p in pieces]
            low_end, high_end = pieces[bisect_right(edges, begin) - 1]
            first, last = max(low_end, begin - 2 * window + 1), min(high_end - window + 1, end + window)
            if first < last:
                out[first:last] = b"\1" * (last - first)
    return out


def own_windows(text: str, window: int = WINDOW) -> bytearray:
    """Per start of a window its own class where that needs fewer bits: 1 for hex, 2 for digits only, else 0.

    Hex has digits and letters a to f of one case. Digits of a window are counted by one character in and one out.
    """
    out = bytearray(len(text) - window + 1)
    for pattern in _HEX_RUNS:
        for run in pattern.finditer(text):
            digits = 0
            for at in range(run.start(), run.end()):
                digits += text[at].isdigit()
                begin = at - window + 1
                if begin > run.start():
                    digits -= text[begin - 1].isdigit()
                if begin >= run.start() and digits:
                    out[begin] = 2 if digits == window else 1
    return out


def entropy_spans(text: str, window: int = WINDOW, thresholds=THRESHOLDS, allowed=ALLOWED) -> list[tuple[int, int]]:
    """From the start of the first window of high entropy to the end of the last, in a candidate.

    There is one such span on each side of windows that allowed parts rule out. A window needs the bits of the class of the
    candidate or of its own class, if these are fewer: a name that is glued to a key does not hide it.
    """
    kind = character_class(text)
    if kind is None or len(text) < window:
        return []
    blocked = blocked_windows(text, window, allowed)
    if kind in WHOLE_PIECES:
        blocked = bytearray(len(text) - window + 1) if blocked is None else blocked
        for at in (k for k, c in enumerate(text) if c in SEPARATORS):
            first, last = max(at - window + 1, 0), min(at + 1, len(blocked))
            blocked[first:last] = b"\1" * max(last - first, 0)
    # The entropy is log2(window) - (sum of n log2 n over the counts) / window.
    most = (log2(window) - thresholds[kind]) * window + 1e-9
    # Windows of a candidate of letters have letters only, so only those of mixed and hex ones can need fewer bits.
    own = own_windows(text, window) if kind in ("mixed", "hex") else None
    most_own = [(log2(window) - min(thresholds[k], thresholds[kind])) * window + 1e-9 for k in (kind, "hex", "digits")]
    weight = _WEIGHT if window <= WINDOW else [0.0] + [n * log2(n) for n in range(1, window + 1)]
    counts: dict[str, int] = {}
    total, first, last = 0.0, None, None
    out = []
    for at, c in enumerate(text):
        if at >= window:
            old = text[at - window]
            n = counts[old]
            counts[old] = n - 1
            total -= weight[n] - weight[n - 1]
        n = counts.get(c, 0)
        counts[c] = n + 1
        total += weight[n + 1] - weight[n]
        begin = at - window + 1
        if begin < 0:
            continue
        if blocked is not None and blocked[begin]:
            if first is not None:
                out.append((first, last))
                first = None
        elif total <= (most if own is None else most_own[own[begin]]):
            first = begin if first is None else first
            last = at + 1
    return out if first is None else [*out, (first, last)]


def entropy_span(text: str, window: int = WINDOW, thresholds=THRESHOLDS, allowed=ALLOWED) -> tuple[int, int] | None:
    """From the start of the first to the end of the last of ``entropy_spans``; None without one."""
    spans = entropy_spans(text, window, thresholds, allowed)
    return (spans[0][0], spans[-1][1]) if spans else None


def _runs(data: np.ndarray, offsets: np.ndarray, letters: np.ndarray, shortest: int):
    """(text, start, end) in bytes of maximal runs of at least so many bytes."""
    starts, ends, _ = words.word_spans(data, offsets, letters)
    long = ends - starts >= shortest
    starts, ends = starts[long], ends[long]
    owner = np.searchsorted(offsets, starts, side="right") - 1
    return zip(owner.tolist(), (starts - offsets[owner]).tolist(), (ends - offsets[owner]).tolist(), strict=True)


def scan(texts: pa.Array):
    """Per text the spans (kind, start, end) in code points, by start and kind."""
    for row, end, data, offsets in words.text_slices(texts):
        raw = data.tobytes()
        found: dict[int, list[tuple[str, int, int]]] = {}
        candidates: dict[int, list[tuple[int, int]]] = {}
        for i, a, b in _runs(data, offsets, _HEX, SHORTEST["hex"]):
            found.setdefault(i, []).append(("hex", a, b))
        for i, a, b in _runs(data, offsets, _TOKEN, WINDOW):
            candidates.setdefault(i, []).append((a, b))
        for i in range(end - row):
            part = raw[offsets[i] : offsets[i + 1]]
            low = part.lower()
            keyed = any(k in low for k in ASSIGN_KEYS)
            access = b"AKIA" in part
            if not (keyed or access or i in found or i in candidates):
                yield row + i, []
                continue
            text = part.decode("utf-8", "replace")
            spans = []
            if keyed:
                spans += [("assign", m.start(), m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= SHORTEST["assign"]]
            if access:
                spans += [("access", m.start(), m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= SHORTEST["access"]]
            if len(text) == len(part):
                place = None
            else:
                # Code points before a byte: bytes that do not continue a character.
                place = np.concatenate([[0], np.cumsum((data[offsets[i] : offsets[i + 1]] & 0xC0) != 0x80)])
            for kind, a, b in found.get(i, []):
                spans.append((kind, a, b) if place is None else (kind, int(place[a]), int(place[b])))
            base = list(spans)
            for a, b in candidates.get(i, []):
                shift = a if place is None else int(place[a])
                for span in entropy_spans(part[a:b].decode("ascii")):
                    low_end, high_end = shift + span[0], shift + span[1]
                    if not any(s <= low_end and high_end <= e for _, s, e in base):
                        spans.append(("entropy", low_end, high_end))
            yield row + i, sorted(spans, key=lambda s: (s[1], KINDS.index(s[0])))


def _joined(spans) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


_FIELDS = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"


def _find(batches):
    for batch in batches:
        rows = []
        for _, spans in scan(batch.column(1)):
            base = [s for s in spans if s[0] != "entropy"]
            counts = [sum(s[0] == kind for s in base) for kind in KINDS[:3]]
            rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
        kinds = [pa.int64()] * 3 + [pa.string()] * 2
        columns = [pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["_id", *[f.split()[0] for f in _FIELDS.split(", ")]])


def scan_secrets(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """Per row: id, counts of the known kinds, ``base_sha256`` of their spans, and ``spans`` of all kinds.

    A span is kind:start:end in code points, end exclusive; spans are ordered by start, then kind. A span of high
    entropy inside one of a known kind is not repeated. Null and empty texts have no spans (an empty string). Null
    ids are carried along, repeated rows come out repeated, an empty table gives an empty result; other columns
    are not looked at.
    """
    kind = docs.schema[id_column].dataType.simpleString()
    rows = batch_map(docs.select(id_column, text_column), _find, f"_id {kind}, {_FIELDS}")
    return rows.withColumnRenamed("_id", id_column)


def op7_secret_scan(spark, sf_dir):
    """Secrets in every document."""
    return scan_secrets(documents(spark, sf_dir))
