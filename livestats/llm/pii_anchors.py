"""Personal data by anchor expansion.

One Aho-Corasick pass over a text finds anchors: at-signs, plus signs, digits,
schemes and identifier cues.  A deterministic parser for each kind expands its
anchor to the whole value and validates it.

Base kinds, leftmost and non-overlapping within a kind:

- ``email``: local part, at-sign, a domain of two or more labels
- ``ip``: four dotted numbers of at most 255
- ``card``: 13 to 19 digits, single spaces or hyphens between, passing Luhn
- ``phone``: a plus sign and 9 to 15 digits with usual punctuation

Added kinds, by the same anchors:

- ``card_part``: a valid card inside a longer run of digits that failed as a whole
- ``phone_part``: a well-formed phone number at the front of a run that failed
- ``url``: a scheme, ``://`` and what follows up to white space or a quote
- ``account``: an IBAN passing its check digits, or the number after an account cue
- ``secret``: the value after a password, token, key or secret cue

Defined cases: a NULL text is the empty text and has no spans; every row is
scanned by itself, so repeated rows and NULL ids keep their rows; offsets are
code points, end exclusive.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BASE_KINDS = ("email", "ip", "card", "phone")
ADDED_KINDS = ("card_part", "phone_part", "url", "account", "secret")
KINDS = BASE_KINDS + ADDED_KINDS

Span = tuple[str, int, int]

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGITS = "0123456789"
_IP = re.compile(r"([0-9]+)\.([0-9]+)\.([0-9]+)\.([0-9]+)")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_PHONE_FRONT = re.compile(r"\+[0-9]{1,3}[ .-]?(?:\([0-9]{1,4}\)[ .-]?)?[0-9]{2,5}(?:[ .-]?[0-9]{2,4}){1,3}(?![0-9])")
_SCHEME = re.compile(r"[A-Za-z][A-Za-z0-9+.-]*$")
_URL_REST = re.compile(r"[^\s\"'<>]+")
_IBAN = re.compile(r"[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_ACCOUNT_TAIL = re.compile(r"[\w ]{0,12}?(?:[#:=]|no\.?|nr\.?)?\s{0,3}((?=[A-Z0-9-]*[0-9]{4})[A-Z0-9][A-Z0-9-]{4,33})\b")
_SECRET_TAIL = re.compile(r"[A-Za-z_]{0,12}[\"']?\s{0,3}[:=]\s{0,3}[\"']?([^\s\"',;]{6,})")

# The cue words.
_ACCOUNT_CUES = ("iban", "account", "acct", "passport", "ssn", "kontonummer", "cuenta", "compte")
_SECRET_CUES = ("password", "passwd", "token", "secret", "api_key", "apikey", "api key")


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for anchor, what in (("@", "at"), ("+", "plus"), ("://", "scheme"), *((d, "digit") for d in _DIGITS)):
        found.add_word(anchor, (what, len(anchor)))
    for cues, what in ((_ACCOUNT_CUES, "account"), (_SECRET_CUES, "secret")):
        for cue in cues:
            for form in {cue, cue.capitalize(), cue.upper()}:
                found.add_word(form, (what, len(form)))
    found.make_automaton()
    return found


_AUTOMATON: list = []


def _luhn(digits: str) -> bool:
    total = 0
    for k, d in enumerate(reversed(digits)):
        n = ord(d) - 48
        if k % 2:
            n = 2 * n - 9 * (n > 4)
        total += n
    return total % 10 == 0


def _is_card(text: str) -> bool:
    digits = text.replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and _luhn(digits)


def _n_digits(text: str) -> int:
    return sum(map(text.count, _DIGITS))


def _cards_inside(text: str, start: int, end: int) -> Iterator[Span]:
    """Valid cards made of whole digit groups of a run that failed as a whole."""
    groups = [(m.start(), m.end()) for m in re.compile("[0-9]+").finditer(text, start, end)]
    k = 0
    while k < len(groups):
        n, last = 0, None
        for j in range(k, len(groups)):
            n += groups[j][1] - groups[j][0]
            if n > 19:
                break
            if n >= 13 and _is_card(text[groups[k][0]:groups[j][1]]):
                last = j
                break
        if last is None:
            k += 1
        else:
            yield "card_part", groups[k][0], groups[last][1]
            k = last + 1


def _iban(text: str, start: int) -> int | None:
    """The end of a valid IBAN that starts here."""
    m = _IBAN.match(text, start)
    if not m:
        return None
    end = m.end()
    while end - start >= 15:
        value = text[start:end].replace(" ", "")
        if 15 <= len(value) <= 34 and int("".join(str(int(c, 36)) for c in value[4:] + value[:4])) % 97 == 1:
            return end
        end = max(end - 1, start)
        while end > start and text[end - 1] == " ":
            end -= 1
    return None


def spans(text: str | None) -> list[Span]:
    """All spans of a text, by kind as listed and then by start."""
    if not text:
        return []
    if not _AUTOMATON:
        _AUTOMATON.append(_automaton())
    out: list[Span] = []
    email_to = digits_to = ip_to = card_to = phone_to = url_to = account_to = secret_to = 0
    for last, (what, size) in _AUTOMATON[0].iter(text):
        at = last + 1 - size
        if what == "digit":
            if at < digits_to:
                continue
            digits_to = at + 1  # runs are read from their first digit only
            while digits_to < len(text) and text[digits_to] in _DIGITS:
                digits_to += 1
            if at >= ip_to and text[digits_to:digits_to + 1] == "." and (m := _IP.match(text, at)):
                ip_to = m.end()
                if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m.groups()):
                    out.append(("ip", at, ip_to))
            if at >= card_to and (m := _CARD.match(text, at)):
                card_to = m.end()
                if card_to - at >= 13:
                    if _is_card(m[0]):
                        out.append(("card", at, card_to))
                    else:
                        out += _cards_inside(text, at, card_to)
        elif what == "at":
            start = at
            while start > email_to and text[start - 1] in _LOCAL:
                start -= 1
            if start < at and (m := _DOMAIN.match(text, at + 1)):
                email_to = m.end()
                out.append(("email", start, email_to))
        elif what == "plus":
            if at >= phone_to and (m := _PHONE.match(text, at)):
                phone_to = m.end()
                if 9 <= _n_digits(m[0]) <= 15:
                    out.append(("phone", at, phone_to))
                elif (m := _PHONE_FRONT.match(text, at, phone_to)) and 9 <= _n_digits(m[0]) <= 15:
                    out.append(("phone_part", at, m.end()))
        elif what == "scheme":
            front = _SCHEME.search(text[max(url_to, at - 32):at])
            rest = _URL_REST.match(text, at + 3)
            if at >= url_to and front and rest:
                url_to = at + 3 + len(rest[0].rstrip(".,;:!?)]}"))
                if url_to > at + 3:
                    out.append(("url", at - len(front[0]), url_to))
        elif what == "account":
            if at < account_to:
                continue
            window = last + 1
            end = None
            for k in range(window, min(window + 16, len(text))):
                if text[k].isupper() and (end := _iban(text, k)):
                    out.append(("account", k, end))
                    account_to = end
                    break
            if not end and not text[window:window + 1].islower() and (m := _ACCOUNT_TAIL.match(text, window)):
                account_to = m.end(1)
                out.append(("account", m.start(1), account_to))
        elif at >= secret_to and (m := _SECRET_TAIL.match(text, last + 1)):
            secret_to = m.end(1)
            out.append(("secret", m.start(1), secret_to))
    order = {k: i for i, k in enumerate(KINDS)}
    return sorted(out, key=lambda s: (order[s[0]], s[1]))


def written(found: list[Span]) -> str:
    return ",".join([f"{k}:{a}:{b}" for k, a, b in found])


def find_pii(docs: DataFrame) -> DataFrame:
    """``doc_id``, counts of the base kinds, the digest of the base spans, and all spans."""
    schema = ("doc_id bigint, n_email bigint, n_ip bigint, n_card bigint, n_phone bigint, "
              "base_sha256 string, spans string")

    def scan(batches):
        for batch in batches:
            found = [spans(t) for t in batch.column("text").to_pylist()]
            base = [[s for s in f if s[0] in BASE_KINDS] for f in found]
            kinds = [[s[0] for s in f] for f in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array([k.count(x) for k in kinds], pa.int64()) for x in BASE_KINDS),
                 pa.array([hashlib.sha256(written(b).encode()).hexdigest() for b in base], pa.string()),
                 pa.array([written(f) for f in found], pa.string())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(scan, schema)


def masked(text: str | None) -> str | None:
    """The text with every span replaced by its kind in brackets; overlapping spans become one."""
    found = sorted(spans(text), key=lambda s: (s[1], -s[2]))
    if not found:
        return text
    out, at, k = [], 0, 0
    while k < len(found):
        kind, start, end = found[k]
        k += 1
        while k < len(found) and found[k][1] < end:
            end = max(end, found[k][2])
            k += 1
        out += [text[at:start], f"[{kind.split('_')[0].upper()}]"]
        at = end
    return "".join([*out, text[at:]])


def mask_pii(docs: DataFrame) -> DataFrame:
    """The same rows and columns with personal data masked in ``text`` (and ``n_chars`` counted anew)."""

    def scan(batches):
        for batch in batches:
            texts = [masked(t) for t in batch.column("text").to_pylist()]
            for name, values in (("text", texts), ("n_chars", [None if t is None else len(t) for t in texts])):
                if name in batch.schema.names:
                    i = batch.schema.get_field_index(name)
                    batch = batch.set_column(i, batch.schema.field(i), pa.array(values, batch.schema.field(i).type))
            yield batch

    return docs.mapInArrow(scan, docs.schema)
