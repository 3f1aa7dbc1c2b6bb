"""Personal data, also in disguise, with spans in the characters of the source.

Plain identifiers are found as they stand.  Then transducers rewrite the disguises of a text: homoglyphs
and full-width forms become ASCII, invisible characters go, spelled digits become digits, and words or
brackets for "at" and "dot" become signs.  Every rewritten character remembers which source characters
it came from, so identifiers in the normal form are spans of the source.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tablelift.llm.common import utf8

KINDS = ("email", "ip", "card", "phone")

# The plain identifiers.  Look-behinds only save attempts that must fail inside a run of digits.
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    """Whether the check digit is right."""
    odd, even = digits[-1::-2], digits[-2::-2]
    return (sum(map(int, odd)) + sum(int(d) // 5 + int(d) * 2 % 10 for d in even)) % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    """Around each @, as far as the characters of a local part and a domain go; linear in the text."""
    found, done, at = [], 0, text.find("@")
    while at >= 0:
        domain = DOMAIN.match(text, at + 1)
        if domain:
            start = at
            while start > done and LOCAL.match(text, start - 1):
                start -= 1
            if start < at:
                found.append((start, domain.end()))
                done = domain.end()
        at = text.find("@", at + 1)
    return found


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Plain identifiers by kind."""
    cards = (m for m in CARD.finditer(text) if m.end() - m.start() >= 13)
    return {
        "email": emails(text) if "@" in text else [],
        "ip": [m.span() for m in IP.finditer(text) if all(_at_most_255(p) for p in m.group().split("."))],
        "card": [m.span() for m in cards if 13 <= len(d := re.sub("[ -]", "", m.group())) <= 19 and luhn(d)],
        "phone": [m.span() for m in PHONE.finditer(text) if 9 <= sum(c.isdigit() for c in m.group()) <= 15] if "+" in text else [],
    }


def _at_most_255(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) <= 3 and int(part or 0) <= 255


# Greek and Cyrillic letters that look like Latin ones.
HOMOGLYPHS = dict(
    zip(
        "аеорсухіјѕһԁԛԝАВЕКМНОРСТУХІЈЅҮαοινρκΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcyxijshdqwABEKMHOPCTYXIJSYaoivpkABEZHIKMNOPTYX",
        strict=True,
    )
)
INVISIBLE = set("\u200b\u200c\u200d\u2060\ufeff\u00ad")
DIGITS = {
    word: str(value % 10)
    for value, words in enumerate(
        ("zero oh null cero zéro", "one eins uno un", "two zwei dos deux", "three drei tres trois", "four vier cuatro quatre",
         "five fünf cinco cinq", "six sechs seis", "seven sieben siete sept", "eight acht ocho huit", "nine neun nueve neuf")
    )
    for word in words.split()
}

_SPELLED = "|".join(sorted(DIGITS, key=len, reverse=True))
#: Spelled digits, groups of digits and plus signs.
NUMBERS = re.compile(rf"(?<!\w)(?:plus|{_SPELLED})(?!\w)|\+?[0-9]+|\+", re.IGNORECASE)

_AT = r"(?:\s{0,2}[\(\[\{<]\s{0,2}(?:at|ät|@|arroba|chez)\s{0,2}[\)\]\}>]\s{0,2}|\s{1,2}(?:at|AT|ät|arroba)\s{1,2}|\s{1,2}@\s{1,2}|\s{1,2}@|@\s{1,2}|_at_|-at-|@)"
_DOT = r"(?:\s{0,2}[\(\[\{<]\s{0,2}(?:dot|punkt|punto|point|\.)\s{0,2}[\)\]\}>]\s{0,2}|\s{1,2}(?:dot|DOT|punkt|punto|point)\s{1,2}|_dot_|-dot-|\.)"
_LABEL = r"[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})"
#: What may stand between the numbers of one identifier.
GAP = re.compile(rf"[ ,.()-]{{0,8}}|{_DOT}", re.IGNORECASE)
#: Digits of the shortest identifier.
LEAST_DIGITS = 4
#: A disguised address: local part, at, and labels of which the last has letters only.
DISGUISED_EMAIL = re.compile(
    rf"(?<![A-Za-z0-9._%+-])(?P<local>[A-Za-z0-9_%+-]{{1,64}}(?:{_DOT}[A-Za-z0-9_%+-]{{1,64}}){{0,3}}?)(?P<at>{_AT})(?P<domain>{_LABEL}(?P<dots>(?:{_DOT}{_LABEL}){{0,3}}{_DOT})(?P<top>[A-Za-z]{{2,24}}))(?![A-Za-z0-9])",
    re.IGNORECASE,
)
#: Addresses with a disguised at and plain dots must end in one of these.
TOPS = set("com org net edu gov io info biz de fr es uk eu us ca ch at it nl co dev app me example test".split())
DISGUISED_IP = re.compile(rf"(?<![0-9.])[0-9]{{1,3}}(?:{_DOT}[0-9]{{1,3}}){{3}}(?![0-9])", re.IGNORECASE)
#: Characters that can be hidden or look like ASCII; Latin letters and common punctuation are not among them.
SUSPECT = re.compile(r"[^\x00-\xac\xae-\u036f\u2010-\u2027\u20a0-\u20bf]")
HINT = re.compile(r"[\(\[\{<_ -](?:at|ät|dot|punkt|punto|point|arroba|chez|@|\.)[\)\]\}>_ -]|\s@|@\s", re.IGNORECASE)
BRACKETS, DOT_WORDS = "([{<_", ("dot", "punkt", "punto", "point")


def may_hide_signs(text: str, low: str) -> bool:
    """Whether the text has a disguised at or dot; cheap tests come first."""
    if "@" in text or any(c in text for c in BRACKETS) or any(w in low for w in DOT_WORDS):
        return HINT.search(text) is not None
    return False


def may_spell_digits(low: str) -> bool:
    return not DIGITS.keys().isdisjoint(re.findall(r"\w+", low))


class Rewriting:
    """A text and, for each of its characters, the span of source characters behind it."""

    def __init__(self, text: str, starts=None, ends=None):
        self.text = text
        self.starts = range(len(text)) if starts is None else starts
        self.ends = range(1, len(text) + 1) if ends is None else ends

    def source(self, start: int, end: int) -> tuple[int, int]:
        return self.starts[start], self.ends[end - 1]

    def replaced(self, spans: list[tuple[int, int, str]]) -> Rewriting:
        """With each (start, end, new) replaced; ascending and not overlapping."""
        if not spans:
            return self
        text, starts, ends, at = [], [], [], 0
        for a, b, new in [*spans, (len(self.text), len(self.text), "")]:
            text.append(self.text[at:a])
            starts += self.starts[at:a]
            ends += self.ends[at:a]
            if new:
                text.append(new)
                starts += [self.starts[a]] * len(new)
                ends += [self.ends[b - 1]] * len(new)
            at = b
        return Rewriting("".join(text), starts, ends)


@lru_cache(maxsize=4096)
def ascii_form(char: str) -> str:
    """What a character stands for in an identifier: ASCII look-alike, nothing, or itself."""
    if char in INVISIBLE:
        return ""
    if char in HOMOGLYPHS:
        return HOMOGLYPHS[char]
    if (digit := unicodedata.digit(char, None)) is not None:
        return str(digit)
    wide = unicodedata.normalize("NFKC", char)
    return wide if len(wide) == 1 and wide.isascii() and char not in "ªº" else char


def look_alikes(text: Rewriting) -> Rewriting:
    """First transducer: homoglyphs, full-width forms, foreign digits and invisible characters."""
    spans = []
    for m in SUSPECT.finditer(text.text):
        new = ascii_form(m.group())
        if new != m.group():
            spans.append((*m.span(), new))
    return text.replaced(spans)


def spelled_digits(text: Rewriting) -> Rewriting:
    """Second transducer: spelled digits beside others, groups of digits, plus signs and words for dots.

    Single digits of which one is spelled are joined; the detectors decide what they make.
    """
    spans: list[tuple[int, int, str]] = []
    run: list[re.Match] = []

    def rewrite():
        names = [m.group().lower() for m in run]
        if not any(n in DIGITS for n in names) or sum(1 if n in DIGITS else sum(c.isdigit() for c in n) for n in names) < LEAST_DIGITS:
            return
        for i, (m, name) in enumerate(zip(run, names)):
            if i:
                a, b = run[i - 1].end(), m.start()
                between, single = text.text[a:b], [n in DIGITS or len(n) == 1 and n.isdigit() for n in names[i - 1 : i + 1]]
                if names[i - 1] in ("plus", "+") or all(single) and (names[i - 1] in DIGITS or name in DIGITS) and not between.strip(" ,-"):
                    spans.append((a, b, ""))
                elif "," in between:
                    spans.append((a, b, between.replace(",", "")))
            if name == "plus" or name in DIGITS:
                spans.append((*m.span(), "+" if name == "plus" else DIGITS[name]))

    for m in NUMBERS.finditer(text.text):
        starts_anew = m.group().startswith("+") or m.group().lower() == "plus"
        if run and (starts_anew or m.start() - run[-1].end() > 20 or not GAP.fullmatch(text.text, run[-1].end(), m.start())):
            rewrite()
            run.clear()
        run.append(m)
    rewrite()
    return text.replaced([s for s in spans if s[0] < s[1]])


def _disguised_emails(text: str):
    for m in DISGUISED_EMAIL.finditer(text):
        at, dots, top = m["at"], m["dots"], m["top"].lower()
        plain_at, plain_dots = at == "@", re.search(r"[^A-Za-z0-9.-]|dot|punkt|punto|point", dots, re.IGNORECASE) is None
        if plain_at and plain_dots and re.fullmatch(r"[A-Za-z0-9._%+-]+", m["local"]):
            continue  # a plain address
        spoken = re.fullmatch(r"\s+[^\W\d_]+\s+", at) is not None
        if spoken and plain_dots and (top not in TOPS or not re.search(r"[0-9._]", m["local"])):
            continue  # "meet at noon.Then" and "see it at example.com": ordinary words
        if at.strip() == "@" and at != "@" and plain_dots and top not in TOPS:
            continue
        yield m.start("local"), m.end("domain")


def added_spans(text: str, base: dict[str, list[tuple[int, int]]]) -> dict[str, list[tuple[int, int]]]:
    """Identifiers that show only in the normal form, as spans of ``text``; none lies within a plain one of its kind.

    A wider one stays beside the plain span that holds a part of it.
    """
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    low = text.lower()
    suspect = not text.isascii() and SUSPECT.search(text)
    normal = look_alikes(Rewriting(text)) if suspect else Rewriting(text)
    if normal.text is not text:
        low = normal.text.lower()
    hint = may_hide_signs(normal.text, low)
    signs = [normal]  # an address may end in a spelled digit or hold one
    if may_spell_digits(low):
        spelled = spelled_digits(normal)
        if spelled is not normal:
            normal = spelled
            signs.append(normal)
    if normal.text is not text:
        for kind, spans in base_spans(normal.text).items():
            found[kind] += [normal.source(*s) for s in spans]
    if hint:
        found["email"] += [form.source(*s) for form in signs for s in _disguised_emails(form.text)]
        for m in DISGUISED_IP.finditer(normal.text):
            if re.search(r"[^0-9.]", m.group()) and all(_at_most_255(p) for p in re.findall("[0-9]+", m.group())):
                found["ip"].append(normal.source(*m.span()))
    for kind, spans in found.items():
        kept: list[tuple[int, int]] = []
        plain, k = sorted(base[kind]), 0
        for a, b in sorted(set(spans), key=lambda s: (s[0], -s[1])):
            while k < len(plain) and plain[k][1] <= a:
                k += 1
            within_plain = k < len(plain) and plain[k][0] <= a and b <= plain[k][1]
            if not within_plain and (not kept or b > kept[-1][1]):
                kept.append((a, b))
        found[kind] = kept
    return found


def spelled_out(spans: dict[str, list[tuple[int, int]]]) -> str:
    """kind:start:end, by kind as listed and then start, joined by commas."""
    return ",".join(f"{k}:{a}:{b}" for k in KINDS for a, b in sorted(spans[k]))


def scan(text: str) -> tuple[dict, dict]:
    """Plain spans and added ones."""
    base = base_spans(text)
    return base, added_spans(text, base)


SCHEMA = pa.schema(
    [("n_email", pa.int64()), ("n_ip", pa.int64()), ("n_card", pa.int64()), ("n_phone", pa.int64()),
     ("base_sha256", pa.string()), ("spans", pa.string()), ("n_added", pa.int64())]
)


def _scan_rows(batches):
    for batch in batches:
        rows = []
        for value in batch.column("text"):
            base, added = scan((value.as_py() or b"").decode("utf-8", "replace"))
            everything = {k: base[k] + added[k] for k in KINDS}
            digest = hashlib.sha256(spelled_out(base).encode()).hexdigest()
            rows.append((*(len(base[k]) for k in KINDS), digest, spelled_out(everything), sum(map(len, added.values()))))
        columns = list(zip(*rows)) or [()] * len(SCHEMA)
        arrays = [pa.array(c, f.type) for c, f in zip(columns, SCHEMA)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *SCHEMA.names])


def find(docs: DataFrame) -> DataFrame:
    """Personal data in ``text`` of every row: doc_id, counts of plain identifiers by kind, the digest of
    their spans, all spans (disguised ones too) and n_added, the number of disguised ones.

    Null and empty texts have none.  A null ``doc_id`` is carried along, repeated rows get a row each, an
    empty table gives no rows, other columns are not read.  Texts are scanned whole; the scans are linear.
    """
    rows = docs.select("doc_id", utf8("text").alias("text"))
    schema = T.StructType(
        [
            docs.select("doc_id").schema.fields[0],
            *[T.StructField(n, T.LongType()) for n in SCHEMA.names[:4]],
            T.StructField("base_sha256", T.StringType()),
            T.StructField("spans", T.StringType()),
            T.StructField("n_added", T.LongType()),
        ]
    )
    return rows.mapInArrow(_scan_rows, schema)


def masked(text: str, mask: str = "[{kind}]") -> str:
    """``text`` with every identifier, plain or disguised, replaced by its kind."""
    base, added = scan(text)
    spans = sorted(((a, b, k) for found in (base, added) for k, own in found.items() for a, b in own), key=lambda s: (s[0], -s[1]))
    merged: list[tuple[int, int, str, int]] = []  # start, end, kind and length of the widest
    for a, b, kind in spans:
        if merged and a < merged[-1][1]:
            start, end, widest, length = merged[-1]
            merged[-1] = (start, max(end, b), *((kind, b - a) if b - a > length else (widest, length)))
        else:
            merged.append((a, b, kind, b - a))
    parts, at = [], 0
    for a, b, kind, _ in merged:
        parts += [text[at:a], mask.format(kind=kind.upper())]
        at = b
    return "".join([*parts, text[at:]])
