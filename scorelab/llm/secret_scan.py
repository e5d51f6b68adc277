"""Secret scan with multipart credential linking.

Strong findings (assignments, access keys, long hex) stand alone.  Weak candidates, which
would drown a report in false alarms, count only in company: an identifier needs a secret
near it, a secret an identifier or an endpoint, an endpoint a secret.  "Near" is an interval
join inside one scope: spans of one block of text (blank lines separate blocks) whose gap is
at most ``reach`` code points.  A scope lies inside one document, so the join runs where the
document is, over sorted spans, and asks only whether a partner exists: no pairs are
listed, and nothing is shuffled.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from itertools import accumulate

from pyspark.sql import DataFrame

from scorelab.llm.common import listed, map_texts, sha256

KINDS = ("assign", "access", "hex", "ident", "secret", "endpoint")
ASSIGN, ACCESS, HEX, IDENT, SECRET, ENDPOINT = range(6)
REACH = 200

# --- fixed values: patterns of the three strong kinds --------------------------
ASSIGN_PATTERN = re.compile(
    r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.A)
ACCESS_PATTERN = re.compile(r"AKIA[A-Z0-9]+")
HEX_PATTERN = re.compile(r"[0-9a-f]{32,}")
# --- end of fixed values --------------------------------------------------------
ASSIGN_HINTS = ("password", "passwd", "secret", "token", "apikey", "api_key")
SETS = r"[\"']?\x20*[:=]\x20*[\"']?"
IDENT_PATTERN = re.compile(
    r"(?<![A-Za-z0-9])(?i:user(?:_?name|_?id)?|login|account|client_?id|app_?id|access_?key(?:_?id)?|key_?id)" + SETS
    + r"[A-Za-z0-9@._-]{3,}", re.A)
IDENT_HINTS = ("user", "login", "account", "client", "app_id", "appid", "key")
ENDPOINT_PATTERN = re.compile(
    r"[A-Za-z][A-Za-z0-9+.-]{1,20}://[^\s\"'<>]{3,}|(?<![A-Za-z0-9])(?i:host(?:_?name)?|endpoint|server|url)" + SETS
    + r"[A-Za-z0-9][A-Za-z0-9.:/_-]{3,}", re.A)
ENDPOINT_HINTS = ("://", "host", "endpoint", "server", "url")
NAMED_SECRET = re.compile(
    r"(?<![A-Za-z0-9])(?i:pass(?:phrase|code)?|pwd|credentials?|private_?key|auth)" + SETS + r"[^\s\"',;]{6,}", re.A)
LONG_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}(?![A-Za-z0-9+/_=-])")
BLANK_LINE = re.compile(r"\n[ \t\r]*\n")


def base_spans(text: str, low: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the strong kinds, leftmost and non-overlapping per kind."""
    found = []
    if any(hint in low for hint in ASSIGN_HINTS):
        found += [(m.start(), ASSIGN, m.end()) for m in ASSIGN_PATTERN.finditer(text) if m.end(1) - m.start(1) >= 8]
    if "AKIA" in text:
        found += [(m.start(), ACCESS, m.end()) for m in ACCESS_PATTERN.finditer(text) if m.end() - m.start() >= 16]
    found += [(m.start(), HEX, m.end()) for m in HEX_PATTERN.finditer(text)]
    return found


def mixed(token: str) -> bool:
    """Whether a token has both cases and digits, and hardly repeats its characters."""
    return (any(c.isdigit() for c in token) and any(c.islower() for c in token) and any(c.isupper() for c in token)
            and len(set(token)) >= min(len(token) // 2, 16))


def weak_parts(text: str, low: str, base: list) -> list[tuple[int, int, int]]:
    """Weak candidates that overlap no strong span.  Secrets are sought only near a possible partner."""
    partners = [(s, k, e) for s, k, e in base if k == ACCESS]
    weak = []
    if any(hint in low for hint in IDENT_HINTS):
        weak += [(m.start(), IDENT, m.end()) for m in IDENT_PATTERN.finditer(text)]
    if any(hint in low for hint in ENDPOINT_HINTS):
        weak += [(m.start(), ENDPOINT, m.end()) for m in ENDPOINT_PATTERN.finditer(text)]
    if weak or partners:
        weak += [(m.start(), SECRET, m.end()) for m in NAMED_SECRET.finditer(text)]
        weak += [(m.start(), SECRET, m.end()) for m in LONG_TOKEN.finditer(text) if mixed(m.group())]
    return without_overlaps(weak, base)


def without_overlaps(weak: list, base: list) -> list:
    """Weak spans in order of start that touch neither a strong span nor an earlier weak one."""
    strong = sorted((s, e) for s, _, e in base)
    starts, ends = [s for s, _ in strong], list(accumulate((e for _, e in strong), max))
    kept, last = [], -1
    for s, k, e in sorted(weak):
        i = bisect_left(starts, e)
        if s >= last and (i == 0 or ends[i - 1] <= s):
            kept.append((s, k, e))
            last = e
    return kept


class Intervals:
    """Sorted spans of one side; ``touches`` tells whether any lies within reach of a span."""

    def __init__(self, spans: list[tuple[int, int]]):
        spans = sorted(spans)
        self.starts = [s for s, _ in spans]
        self.ends = list(accumulate((e for _, e in spans), max))

    def touches(self, start: int, end: int, reach: int) -> bool:
        # The first span whose end is far enough right also has the smallest start of all such.
        i = bisect_left(self.ends, start - reach)
        return i < len(self.starts) and self.starts[i] <= end + reach


def linked(weak: list, base: list, breaks: list[int], reach: int) -> list:
    """The weak spans with a complementary part in their scope and reach."""
    scopes: dict[int, list] = {}
    for span in [*base, *weak]:
        scopes.setdefault(bisect_left(breaks, span[0]), []).append(span)
    kept = []
    for spans in scopes.values():
        secrets = Intervals([(s, e) for s, k, e in spans if k in (ASSIGN, HEX, SECRET)])
        places = Intervals([(s, e) for s, k, e in spans if k in (ACCESS, IDENT, ENDPOINT)])
        for s, k, e in spans:
            if k in (IDENT, ENDPOINT) and secrets.touches(s, e, reach) or k == SECRET and places.touches(s, e, reach):
                kept.append((s, k, e))
    return kept


def scan(text: str | None, reach: int = REACH) -> tuple[list, list]:
    """Strong spans and linked weak spans of one text."""
    if not text:
        return [], []
    low = text.lower()
    base = base_spans(text, low)
    weak = weak_parts(text, low, base)
    if weak:
        weak = linked(weak, base, [m.start() for m in BLANK_LINE.finditer(text)], reach)
    return base, weak


def find_secrets(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``found`` (kind, start, end, strong) by start, then kind.

    Offsets are code points, ends exclusive.  Null and empty texts have no findings; repeated
    rows and null ids each give their own row; other columns are neither read nor returned.
    """
    def rows_of(ids, texts):
        found = []
        for text in texts:
            base, weak = scan(text, reach)
            strong = set(base)
            found.append([{"kind": KINDS[s[1]], "start": s[0], "end": s[2], "strong": s in strong} for s in sorted(base + weak)])
        return {"doc_id": ids, "found": found}

    kind = dict(docs.dtypes)["doc_id"]
    return map_texts(docs, rows_of, f"doc_id {kind}, found array<struct<kind string, start int, end int, strong boolean>>")


def secret_digests(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """Counts per strong kind, digest of the strong spans and all spans as text, one row per document."""
    def rows_of(ids, texts):
        out = {n: [] for n in ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_linked")}
        for text in texts:
            base, weak = scan(text, reach)
            for kind, name in ((ASSIGN, "n_assign"), (ACCESS, "n_access"), (HEX, "n_hex")):
                out[name].append(sum(k == kind for _, k, _ in base))
            out["base_sha256"].append(sha256(listed(base, KINDS)))
            out["spans"].append(listed(base + weak, KINDS))
            out["n_linked"].append(len(weak))
        return {"doc_id": ids} | out

    kind = dict(docs.dtypes)["doc_id"]
    return map_texts(docs, rows_of, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_linked long")
