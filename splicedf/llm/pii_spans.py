"""Personal data in a text: the base patterns, high-recall candidates and their features. Runs inside tasks."""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import Counter
from itertools import accumulate

#: Base kinds, in the order of results; the kinds that candidates add come after them.
BASE, ADDED = ("email", "ip", "card", "phone"), ("number", "secret")
ORDER = (*BASE, *ADDED)
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# a failure at the start of a run of digits is one at each later digit too: look-behind and possessive runs stay linear
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY_DIGIT, NOT_DIGIT = re.compile("[0-9]"), re.compile("[^0-9]")

KINDS = ("email", "ip", "number", "secret")
#: Generators propose; most of what they propose is not personal data. Runs are taken whole, however long: each is read once.
DOTTED = re.compile(r"(?<![0-9.])[0-9]++(?:\.[0-9]++){2,}+")
DIGITS = re.compile(r"\+?\(?[0-9](?:[\x20().-]{0,2}[0-9])*+")
KEYLIKE = re.compile(r"[A-Za-z0-9+/_-]{16,}+={0,2}")
LEAST_DIGITS = 7
#: Words of the text before a candidate that speak for personal data, fixed values: by kind.
CUES = {
    "email": re.compile(r"(?i)e-?mail|contact|write|address"),
    "ip": re.compile(r"(?i)\bip\b|host|server|address"),
    "number": re.compile(r"(?i)card|visa|account|iban|phone|tel|call|mobile|fax|ssn|passport"),
}
ASSIGNED = re.compile(r"(?i)(?:token|key|secret|passw\w*|pwd|auth\w*)\"?\s*[=:]\s*[\"']?$")
FEATURES = ("kind_email", "kind_ip", "kind_number", "kind_secret", "length", "digits", "letters", "upper", "hex_share", "entropy", "separators", "groups", "dots", "cue", "before", "after")
CONTEXT = 40


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        x = int(d) * (1 + i % 2)
        total += x - 9 * (x > 9)
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches of local part, @ and domain; each match has one @, so the @ are walked, not the letters."""
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            out.append((start, m.end()))
            done = m.end()
        at = text.find("@", max(done, at + 1))
    return out


def base_spans(text: str) -> list[tuple[str, int, int]]:
    found = [("email", *x) for x in emails(text)] if "@" in text else []
    if not ANY_DIGIT.search(text):
        return found
    found += [("ip", *m.span()) for m in IP.finditer(text) if all(int(p[-4:]) <= 255 and len(p.lstrip("0")) <= 3 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = NOT_DIGIT.sub("", m[0])
        if 13 <= len(digits) <= 19 and luhn(digits):
            found.append(("card", *m.span()))
    if "+" in text:
        found += [("phone", *m.span()) for m in PHONE.finditer(text) if 9 <= len(NOT_DIGIT.sub("", m[0])) <= 15]
    return found


def entropy(s: str) -> float:
    return -sum(n / len(s) * math.log2(n / len(s)) for n in Counter(s).values())


def shape(c: str) -> float:
    return 0.0 if not c else 1.0 if c.isspace() else 2.0 if c.isalpha() else 3.0 if c.isdigit() else 4.0


def features(kind: str, text: str, start: int, end: int) -> list[float]:
    """What the trees see. The label is hidden from them: of a secret it is the text before, so they see its form alone;
    of other kinds it is that a base pattern matches, so they see no checksum, range of parts, domain or plus sign."""
    s = text[start:end]
    digits, letters = len(NOT_DIGIT.sub("", s)), sum(c.isalpha() for c in s)
    context = [0.0] * 3 if kind == "secret" else [float(bool(CUES[kind].search(text[max(0, start - CONTEXT) : start]))), shape(text[start - 1 : start]), shape(text[end : end + 1])]
    return [
        *(float(kind == k) for k in KINDS), float(end - start), float(digits), float(letters), float(sum(c.isupper() for c in s)),
        sum(c in "0123456789abcdefABCDEF" for c in s) / len(s), entropy(s), float(len(s) - digits - letters), float(len(re.findall("[0-9]+", s))), float(s.count(".")), *context,
    ]


def mails(text: str) -> list[tuple[int, int]]:
    """What stands around an @, up to white space or another @."""
    out, at = [], text.find("@")
    while at >= 0:
        start = end = at
        while start and not text[start - 1].isspace() and text[start - 1] != "@":
            start -= 1
        end = at + 1
        while end < len(text) and not text[end].isspace() and text[end] != "@":
            end += 1
        if start < at and end > at + 1:
            out.append((start, end))
        at = text.find("@", max(at + 1, end))
    return out


def proposed(text: str) -> list[tuple[str, int, int]]:
    out = [("email", *x) for x in mails(text)] if "@" in text else []
    if ANY_DIGIT.search(text):
        out += [("ip", *m.span()) for m in DOTTED.finditer(text)]
        for m in DIGITS.finditer(text):
            alone = not text[m.start() - 1 : m.start()].isalnum() and not text[m.end() : m.end() + 1].isalnum()
            if alone and len(NOT_DIGIT.sub("", m[0])) >= LEAST_DIGITS:
                out.append(("number", *m.span()))
    out += [("secret", *m.span()) for m in KEYLIKE.finditer(text)]
    return out


def candidates(text: str, base: list[tuple[str, int, int]]) -> list[dict]:
    """Proposed spans with features and a weak label: whether a base span lies within, or a secret is assigned to a name."""
    spans = sorted((s, e) for _, s, e in base)
    starts, reach = [s for s, _ in spans], list(accumulate((e for _, e in spans), max))
    out = []
    for kind, start, end in proposed(text):
        before = bisect_left(starts, end)
        touches = before > 0 and reach[before - 1] > start
        if kind == "secret":
            label = bool(ASSIGNED.search(text[max(0, start - CONTEXT) : start]))
        else:
            label = any(e <= end for _, e in spans[bisect_left(starts, start) : before])
        out.append({"kind": kind, "start": start, "end": end, "label": float(label), "base": touches, "features": features(kind, text, start, end)})
    return out


def rows(batches):
    """mapInArrow: (_id, _th, text) to (_id, _th, base, candidates)."""
    import pyarrow as pa

    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    cand = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("label", pa.float64()), ("base", pa.bool_()), ("features", pa.list_(pa.float64()))])
    for batch in batches:
        base, more = [], []
        for text in batch.column(2).to_pylist():
            b = base_spans(text or "")
            base.append([{"kind": k, "start": s, "end": e} for k, s, e in b])
            more.append(candidates(text or "", b))
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(base, pa.list_(span)), pa.array(more, pa.list_(cand))], ["_id", "_th", "base", "candidates"])
