"""Personal data by anchor expansion.

One Aho-Corasick automaton finds the anchors of a text: at-signs, URL schemes,
plus signs before digits, digits and identifier cues. Deterministic local
parsers then expand each anchor to the boundaries of an address or account and
validate it. No regular expression runs over the text.

Kinds: ``email``, ``ip`` (parts at most 255), ``card`` (14 to 19 digits that
pass Luhn's check), ``phone`` (``+`` and 10 to 15 digits), ``iban`` (mod-97
check), ``account`` (6 to 20 letters and digits with four digits at least,
right after a cue such as ``account no:``) and ``login`` (``user:password@``
after a scheme). Spans are in code points, end exclusive. Spans of one kind
don't overlap; a match that fails validation uses its characters up.

Edge cases: null and empty texts have no spans; repeated rows are judged each
for itself; an input column that has the result's name is replaced.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .frames import annotate, lists

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "account", "login")
CUES = ("account", "acct", "iban", "passport", "ssn", "social security", "tax id", "customer id", "member id", "patient id", "routing")
SCHEMES = ("http://", "https://", "ftp://", "ssh://", "mailto:")

DIGITS = frozenset("0123456789")
LETTERS = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ")
ALNUM = DIGITS | LETTERS
LOCAL = ALNUM | frozenset("._%+-")
LABEL = ALNUM | frozenset("-")
PHONE = DIGITS | frozenset(" ().-")

FOUND = "spans array<struct<kind:string, start:long, end:long>>"


def _run(text: str, at: int, allowed: frozenset, limit: int | None = None) -> int:
    """End of the run of ``allowed`` characters that starts at ``at``."""
    limit = len(text) if limit is None else limit
    while at < limit and text[at] in allowed:
        at += 1
    return at


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) << (k & 1)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def iban_valid(code: str) -> bool:
    return int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1


def email_at(text: str, at: int, floor: int) -> tuple[int, int] | None:
    """The address around the at-sign at ``at``, not before ``floor``."""
    start = at
    while start > floor and text[start - 1] in LOCAL:
        start -= 1
    end = _run(text, at + 1, LABEL)
    labels = 0
    while end > at + 1 and end < len(text) and text[end] == "." and (stop := _run(text, end + 1, LABEL)) > end + 1:
        end, labels = stop, labels + 1
    return (start, end) if labels and start < at else None


def ip_at(text: str, at: int) -> tuple[int, bool]:
    """End of four dotted numbers that start at ``at`` (``at`` if there are
    fewer), and whether none exceeds 255."""
    end, valid = at, True
    for part in range(4):
        begin = end
        if part:
            if end >= len(text) or text[end] != ".":
                return at, False
            begin = end + 1
        end = _run(text, begin, DIGITS)
        if end == begin:
            return at, False
        digits = text[begin:end].lstrip("0")
        valid &= len(digits) <= 3 and int(digits or "0") <= 255
    return end, valid


def card_at(text: str, at: int) -> tuple[int, int]:
    """End of a run of digits with single spaces or hyphens between them, and
    the number of digits."""
    end, n, size = at + 1, 1, len(text)
    while end < size:
        if text[end] in DIGITS:
            end += 1
        elif text[end] in " -" and end + 1 < size and text[end + 1] in DIGITS:
            end += 2
        else:
            break
        n += 1
    return end, n


def phone_at(text: str, at: int) -> int:
    """End of a number that starts with the plus sign at ``at``, or ``at``."""
    end = _run(text, at + 2, PHONE)
    while end > at + 3 and text[end - 1] not in DIGITS:
        end -= 1
    return end if end > at + 3 and text[end - 1] in DIGITS else at


def iban_at(text: str, at: int) -> int:
    """End of an account code (two letters, two digits, groups of letters and
    digits) that passes the mod-97 check, or ``at``."""
    if not (text[at : at + 2].isupper() and text[at : at + 2].isascii() and text[at : at + 2].isalpha() and text[at + 2 : at + 4].isdigit() and text[at + 2 : at + 4].isascii()):
        return at
    end, code, ends = at, [], {}
    while end < len(text) and len(code) < 34:
        if text[end] in ALNUM and not text[end].islower():
            code.append(text[end])
            end += 1
            ends[len(code)] = end
        elif text[end] == " " and len(code) % 4 == 0 and end + 1 < len(text) and text[end + 1] in ALNUM and not text[end + 1].islower():
            end += 1
        else:
            break
    for n in range(len(code), 14, -1):
        if iban_valid("".join(code[:n])) and (ends[n] == len(text) or text[ends[n]] not in ALNUM):
            return ends[n]
    return at


def account_after(text: str, at: int) -> tuple[int, int] | None:
    """The account number right after a cue that ends at ``at``."""
    if at < len(text) and text[at] in LETTERS:
        return None
    at = _run(text, at, frozenset(" "))
    for word in ("number", "no.", "no", "id", "code"):
        if text[at : at + len(word)].lower() == word and text[at + len(word) : at + len(word) + 1] not in LETTERS:
            at = _run(text, at + len(word), frozenset(" "))
            break
    sign = at
    at = _run(text, at, frozenset(":#="))
    begin = _run(text, at, frozenset(" "))
    if begin == sign:  # neither a sign nor a space: not a number of the cue's
        return None
    end = _run(text, begin, LABEL)
    while end > begin and text[end - 1] == "-":
        end -= 1
    digits = sum(c in DIGITS for c in text[begin:end])
    return (begin, end) if digits >= 4 and 6 <= end - begin <= 20 else None


class Logins:
    """``user:password`` between a scheme and an at-sign. A scheme within the
    stretch that the last one was followed by needs no scan of its own."""

    def __init__(self, text: str):
        self.text, self.end, self.colon = text, -1, -1

    def after(self, at: int) -> tuple[int, int] | None:
        """The login right after a scheme that ends at ``at``, which ascends."""
        text = self.text
        if at > self.end:
            end = at
            while end < len(text) and text[end] not in " \t\r\n/?#@\"'<>":
                end += 1
            self.end, self.colon = end, text.rfind(":", at, end)
        return (at, self.end) if self.end < len(text) and text[self.end] == "@" and self.colon > at else None


def _cases(words: tuple[str, ...]) -> set[str]:
    return {form for w in words for form in (w, w.upper(), w.capitalize(), w.title())}


def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, words in (("@", "@"), ("+", [f"+{d}" for d in range(10)]), ("0", DIGITS), ("cue", _cases(CUES)), ("scheme", _cases(SCHEMES))):
        for w in words:
            found.add_word(w, (kind, len(w)))
    found.make_automaton()
    return found


def find_spans(text: str, automaton) -> list[tuple[int, str, int]]:
    """(start, kind, end) by start, then kind as in KINDS."""
    spans: list[tuple[int, str, int]] = []
    done = dict.fromkeys(KINDS, 0)
    logins = Logins(text)
    for last, (kind, size) in automaton.iter(text):
        at = last + 1 - size
        if kind == "0":
            fresh = at == 0 or text[at - 1] not in DIGITS
            if at >= done["ip"] and (fresh or at == done["ip"]):
                end, valid = ip_at(text, at)
                if end > at:
                    done["ip"] = end
                    if valid:
                        spans.append((at, "ip", end))
            if at >= done["card"]:
                end, n = card_at(text, at)
                done["card"] = end
                if 14 <= n <= 19 and luhn("".join(c for c in text[at:end] if c in DIGITS)):
                    spans.append((at, "card", end))
            if fresh and at >= 2 and at - 2 >= done["iban"] and text[at - 1] in LETTERS and text[at - 2] in LETTERS and (at < 3 or text[at - 3] not in ALNUM):
                end = iban_at(text, at - 2)
                if end > at - 2:
                    done["iban"] = end
                    spans.append((at - 2, "iban", end))
        elif kind == "@":
            if (found := email_at(text, at, done["email"])) is not None:
                done["email"] = found[1]
                spans.append((found[0], "email", found[1]))
        elif kind == "+":
            if at >= done["phone"] and (end := phone_at(text, at)) > at:
                done["phone"] = end
                if 10 <= sum(c in DIGITS for c in text[at:end]) <= 15:
                    spans.append((at, "phone", end))
        elif kind == "cue":
            if (at == 0 or text[at - 1] not in ALNUM) and (found := account_after(text, last + 1)) and found[0] >= done["account"]:
                done["account"] = found[1]
                spans.append((found[0], "account", found[1]))
        elif (found := logins.after(last + 1)) and found[0] >= done["login"]:
            done["login"] = found[1]
            spans.append((found[0], "login", found[1]))
    spans.sort(key=lambda s: (s[0], KINDS.index(s[1])))
    return spans


def _finder() -> Callable[[pa.Array], dict]:
    automaton = _automaton()

    def find(texts: pa.Array) -> dict:
        found = [find_spans(t, automaton) if t else [] for t in texts.to_pylist()]
        flat = [s for f in found for s in f]
        values = pa.StructArray.from_arrays([pa.array([s[1] for s in flat], pa.string()), pa.array([s[0] for s in flat], pa.int64()), pa.array([s[2] for s in flat], pa.int64())], names=["kind", "start", "end"])
        return {"spans": lists(values, np.fromiter(map(len, found), np.int64, len(found)))}

    return find


def find_personal_data(docs: DataFrame, text: str = "text", name: str = "pii") -> DataFrame:
    """``docs`` with struct column ``name`` that holds all ``spans``."""
    return annotate(docs, text, name, FOUND, _finder)


def redact(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with each span replaced by its kind in brackets; overlapping
    spans become one, named after the first."""
    at = [c.lower() for c in docs.columns].index(text.lower())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton = _automaton()
        for batch in batches:
            out = []
            for value in batch.column(at).to_pylist():
                if value:
                    last, kept = 0, []
                    for start, kind, end in find_spans(value, automaton):
                        if start >= last:
                            kept += [value[last:start], f"[{kind.upper()}]"]
                        last = max(last, end)
                    value = "".join([*kept, value[last:]]) if kept else value
                out.append(value)
            columns = list(batch.columns)
            columns[at] = pa.array(out, pa.string())
            yield pa.RecordBatch.from_arrays(columns, names=batch.schema.names)

    return docs.mapInArrow(run, T.StructType([T.StructField(f.name, T.StringType()) if i == at else f for i, f in enumerate(docs.schema.fields)]))


def personal_data_digest(found: DataFrame, doc_id: str = "doc_id", name: str = "pii") -> DataFrame:
    """Counts of the base kinds, the hash of their spans, and all spans as text."""
    spans = F.col(name)["spans"]
    written = lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
    of_kind = lambda k: F.size(F.filter(spans, lambda s: s["kind"] == k))
    base = F.filter(spans, lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        doc_id,
        *[of_kind(k).cast("long").alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(F.array_join(F.transform(base, written), ","), 256).alias("base_sha256"),
        F.array_join(F.transform(spans, written), ",").alias("spans"),
    )
