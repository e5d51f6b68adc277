"""Personal data with offset-preserving deobfuscation.

Plain finds (e-mail, IP, card, phone) are matched in the text as it stands.  Disguised ones
are matched in a normalised copy: a chain of transducers turns homoglyphs and full-width forms
into ASCII, drops invisible characters, reads spelled digits and at/dot disguises.  Every
transducer keeps a map from its output positions to source positions, maps compose, and a
find in the normalised copy is reported as the span of source characters it came from.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from itertools import accumulate

from pyspark.sql import DataFrame

from scorelab.llm.common import listed, map_texts, sha256

KINDS = ("email", "ip", "card", "phone")
EMAIL, IP, CARD, PHONE = range(4)

# --- fixed values: patterns of the four kinds ------------------------------------
EMAIL_PATTERN = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never begins inside a run of digits; saying so keeps long runs linear.
IP_PATTERN = re.compile(r"(?<![0-9])([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
CARD_PATTERN = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE_PATTERN = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
# --- end of fixed values ---------------------------------------------------------
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NOT_DIGITS = re.compile(r"[^0-9]")
# A card has 14 digits with at most one separator between two, so such a run must be there.
LONG_DIGITS = re.compile(r"[0-9](?:[\x20-]?[0-9]){13,}")

#: Letters of other scripts that look like the Latin letter in the same place.
HOMOGLYPHS = str.maketrans(
    "АВЕКМНОРСТХаеорсухіјѕԁԛԝΑΒΕΖΗΙΚΜΝΟΡΤΥΧοıℓ",
    "ABEKMHOPCTXaeopcyxijsdqwABEZHIKMNOPTYXoil",
)
FULL_WIDTH = {code: code - 0xFEE0 for code in range(0xFF01, 0xFF5F)}
OTHER_DIGITS = {first + d: ord("0") + d for first in (0x0660, 0x06F0, 0x0966, 0x1D7CE, 0x1D7F6) for d in range(10)}
ONE_TO_ONE = HOMOGLYPHS | FULL_WIDTH | OTHER_DIGITS | {ord("．"): ord("."), ord("。"): ord("."), 0xA0: 0x20, 0x2007: 0x20, 0x202F: 0x20, 0x2010: 0x2D, 0x2011: 0x2D, 0x2012: 0x2D, 0x2013: 0x2D}
UNUSUAL = re.compile("[" + "".join(map(re.escape, map(chr, ONE_TO_ONE))) + "]")
INVISIBLE = re.compile("[\u00ad\u200b-\u200f\u2060\ufeff]+")

SPELLED = {"zero": "0", "oh": "0", "one": "1", "two": "2", "three": "3", "four": "4", "five": "5", "six": "6",
           "seven": "7", "eight": "8", "nine": "9"}
NUMBER_WORD = r"(?:zero|oh|one|two|three|four|five|six|seven|eight|nine)"
#: Four or more spelled digits in a row, figures allowed between them; single number words stay words.
SPELLED_RUN = re.compile(rf"(?i:(?<![A-Za-z0-9]){NUMBER_WORD}(?:[\x20.,-]{{1,3}}(?:{NUMBER_WORD}|[0-9]+)){{3,}}(?![A-Za-z]))", re.A)
#: Two number words, or one and a figure, in a row: a cheap test on lower-cased text.
SPELLED_HINT = re.compile(rf"{NUMBER_WORD}[\x20.,-]{{1,3}}(?:{NUMBER_WORD}|[0-9])")
SPELLED_WORD = re.compile(rf"(?i:{NUMBER_WORD})", re.A)
PLUS_WORD = re.compile(r"(?i:(?<![A-Za-z])plus\x20+)(?=[0-9])", re.A)

_OPEN, _CLOSE = r"\x20{0,3}[\[({<]\x20{0,3}", r"\x20{0,3}[\])}>]\x20{0,3}"
_AT = rf"(?:{_OPEN}(?i:at|@){_CLOSE}|\x20{{1,3}}(?i:at|@)\x20{{1,3}}|@\x20{{0,3}}|\x20{{1,3}}@)"
#: A dot in words or brackets; plain dots belong to the text around it.
_DOT_WORD = rf"(?:{_OPEN}(?i:dot|punkt|punto|\.){_CLOSE}|\x20{{1,3}}(?i:dot|punkt|punto)\x20{{1,3}})"
#: A local part, an at in any form, labels with dots in any form.
DISGUISED_MAIL = re.compile(
    rf"(?P<local>[A-Za-z0-9%+-](?:[A-Za-z0-9._%+-]|{_DOT_WORD}(?=[A-Za-z0-9])){{0,64}})(?P<at>{_AT})"
    rf"(?P<domain>[A-Za-z0-9-]+(?:(?:{_DOT_WORD}|\.)[A-Za-z0-9-]+)+)", re.A)
#: Any dot that is a word or in brackets, any at in brackets or beside a blank.  A bare "at" counts only with such a dot.
DISGUISE_HINT = re.compile(
    r"[\x20\[({<](?:dot|punkt|punto)[\x20\])}>]|[\[({<]\x20{0,3}(?:at|@|\.)\x20{0,3}[\])}>]|\x20@|@\x20")
DOT_WORD = re.compile(_DOT_WORD, re.A)
#: Figures with a spelled or bracketed dot between them: 10 dot 0 dot 0 dot 1.
DISGUISED_IP = re.compile(rf"[0-9]{{1,4}}(?:(?:{_DOT_WORD}|\.)[0-9]{{1,4}}){{3}}", re.A)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int, int]]:
    """Leftmost, non-overlapping; sought from the @ signs, which are rare, to both sides."""
    found, last = [], 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in LOCAL:
            start -= 1
        m = DOMAIN.match(text, at + 1) if start < at else None
        if m:
            last = m.end()
            found.append((start, EMAIL, last))
        at = text.find("@", max(at + 1, last))
    return found


def plain_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the four kinds in the text as it stands."""
    found = emails(text)
    if "." in text:
        found += [(m.start(), IP, m.end()) for m in IP_PATTERN.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p) > 3 else p) <= 255 for p in m.groups())]
    if LONG_DIGITS.search(text):
        for m in CARD_PATTERN.finditer(text):
            if 14 <= m.end() - m.start():
                digits = NOT_DIGITS.sub("", m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    found.append((m.start(), CARD, m.end()))
    if "+" in text:
        found += [(m.start(), PHONE, m.end()) for m in PHONE_PATTERN.finditer(text) if 10 <= len(NOT_DIGITS.sub("", m.group())) <= 15]
    return found


class Edited:
    """A text with replacements: the new text, and for each of its pieces the source span.

    Unchanged pieces map character by character; a replacement maps as a whole, so that a
    find that touches it covers all the source characters it was read from.
    """

    def __init__(self, text: str, edits: list[tuple[int, int, str]]):
        pieces, self.at, self.source, self.changed = [], [], [], []
        place = out = 0
        for start, end, new in [*edits, (len(text), len(text), None)]:
            if start > place:
                self._piece(out, place, start, False)
                pieces.append(text[place:start])
                out += start - place
            if new:
                self._piece(out, start, end, True)
                pieces.append(new)
                out += len(new)
            place = end
        self.text = "".join(pieces)

    def _piece(self, out: int, start: int, end: int, changed: bool) -> None:
        self.at.append(out)
        self.source.append((start, end))
        self.changed.append(changed)

    def span(self, start: int, end: int) -> tuple[int, int]:
        i, j = bisect_right(self.at, start) - 1, bisect_right(self.at, end - 1) - 1
        first = self.source[i][0] + (0 if self.changed[i] else start - self.at[i])
        last = self.source[j][1] if self.changed[j] else self.source[j][0] + end - self.at[j]
        return first, last


def spelled_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in SPELLED_RUN.finditer(text):
        words = list(SPELLED_WORD.finditer(text, m.start(), m.end()))
        for i, word in enumerate(words):
            follows = i + 1 < len(words) and not text[word.end() : words[i + 1].start()].strip(" .,-")
            edits.append((word.start(), words[i + 1].start() if follows else word.end(), SPELLED[word.group().lower()]))
    return edits


def disguise_edits(text: str) -> list[tuple[int, int, str]]:
    edits = []
    for m in DISGUISED_MAIL.finditer(text):
        at = m["at"]
        dots = list(DOT_WORD.finditer(text, m.start("local"), m.end("local")))
        far_dots = list(DOT_WORD.finditer(text, m.start("domain"), m.end("domain")))
        # A bare "at" in front of a plain domain is ordinary prose.
        if far_dots or not at.strip().isalpha():
            edits += [(d.start(), d.end(), ".") for d in dots + far_dots]
            edits += [(m.start("at"), m.end("at"), "@")] * (at != "@")
    for m in DISGUISED_IP.finditer(text):
        edits += [(d.start(), d.end(), ".") for d in DOT_WORD.finditer(text, m.start(), m.end())]
    edits.sort()
    ends = list(accumulate((e for _, e, _ in edits), max, initial=0))
    return [e for e, before in zip(edits, ends) if e[0] >= before]


def normalised(text: str) -> tuple[str, list[Edited]] | None:
    """The deobfuscated text and its chain of maps; None when nothing had to change."""
    chain, now = [], text

    def apply(edits):
        nonlocal now
        if edits:
            chain.append(Edited(now, edits))
            now = chain[-1].text

    changed = False
    if not text.isascii():
        apply([(m.start(), m.end(), "") for m in INVISIBLE.finditer(now)])
        if UNUSUAL.search(now):
            now, changed = now.translate(ONE_TO_ONE), True  # one to one: offsets stay
    low = now.lower()
    if SPELLED_HINT.search(low):
        apply(spelled_edits(now))
    if "plus " in low:
        apply([(m.start(), m.end(), "+") for m in PLUS_WORD.finditer(now)])
    if DISGUISE_HINT.search(low):
        apply(disguise_edits(now))
    return (now, chain) if chain or changed else None


def scan(text: str | None) -> tuple[list, list]:
    """Plain spans, and spans found after deobfuscation that lie in no plain one of their kind."""
    if not text:
        return [], []
    base = plain_spans(text)
    clean = normalised(text)
    if clean is None:
        return base, []
    taken = {k: sorted((s, e) for s, kind, e in base if kind == k) for k in range(len(KINDS))}
    added = []
    for s, k, e in plain_spans(clean[0]):
        for edited in reversed(clean[1]):
            s, e = edited.span(s, e)
        spans = taken[k]
        i = bisect_left(spans, (s + 1, 0))
        if not (i and spans[i - 1][1] >= e):
            added.append((s, k, e))
    return base, added


def find_personal_data(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and ``found`` (kind, start, end, plain, text) by start, then kind.

    Spans are code points of the source text, ends exclusive.  Null and empty texts have no
    findings; repeated rows and null ids each give their own row; other columns are ignored.
    """
    def rows_of(ids, texts):
        found = []
        for text in texts:
            base, added = scan(text)
            plain = set(base)
            found.append([{"kind": KINDS[x[1]], "start": x[0], "end": x[2], "plain": x in plain, "text": text[x[0] : x[2]]} for x in sorted(base + added)])
        return {"doc_id": ids, "found": found}

    kind = dict(docs.dtypes)["doc_id"]
    return map_texts(docs, rows_of, f"doc_id {kind}, found array<struct<kind string, start int, end int, plain boolean, text string>>")


def personal_digests(docs: DataFrame) -> DataFrame:
    """Counts per kind (plain spans), digest of the plain spans and all spans as text."""
    def rows_of(ids, texts):
        out = {n: [] for n in ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_disguised")}
        for text in texts:
            base, added = scan(text)
            for kind, name in enumerate(("n_email", "n_ip", "n_card", "n_phone")):
                out[name].append(sum(k == kind for _, k, _ in base))
            out["base_sha256"].append(sha256(listed(base, KINDS)))
            out["spans"].append(listed(base + added, KINDS))
            out["n_disguised"].append(len(added))
        return {"doc_id": ids} | out

    kind = dict(docs.dtypes)["doc_id"]
    return map_texts(docs, rows_of, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_disguised long")
