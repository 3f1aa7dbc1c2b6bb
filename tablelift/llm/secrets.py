"""Secrets in texts: plain patterns, and candidates scored by automata inferred from labelled credentials.

The plain patterns label credentials by their kind.  From a bounded sample of these each format gets a
probabilistic automaton: the prefix tree of the sample, written in character classes, whose states are
merged while their distributions of continuations are statistically compatible (Hoeffding's bound).
Every run of credential characters is then scored, character by character, by its likelihood under each
format against that as words, numbers and signs, where words follow the letter pairs of the same texts.
The stretches of a run in which a format is likelier by the margin are found.
"""

from __future__ import annotations

import hashlib
import math
import re
from uuid import uuid4

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tablelift.llm.common import all_columns, free_names, utf8
from tablelift.session import materialize

KINDS = ("assign", "access", "hex")

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}+")

#: Labelled credentials per format and background words that the automata are fitted on at most.
SAMPLE = 2000
#: Characters of a credential that matter for its format.
DEPTH = 64
#: Confidence of the merge test; smaller merges more.
ALPHA = 0.05
#: A candidate is a secret if its likelihood per character beats that of words by this factor (natural logarithm).
MARGIN = 1.0
#: Characters of a secret at least.
LEAST = 16
#: Candidates: runs of credential characters, segments joined by dots included.
CANDIDATE = re.compile(rf"(?:[A-Za-z0-9+/_=-]|(?<=[A-Za-z0-9+/_=-])\.(?=[A-Za-z0-9+/_=-])){{{LEAST},}}+")
#: Parts of a run as words, numbers and signs would make it up.
PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+|.", re.DOTALL)
#: Logarithms: a new word or number, a sign, going on with a number, a character as the one before.
NEW_PART, NEW_SIGN, MORE_DIGITS, SAME = -4.5, -2.8, -0.2, -0.7
#: Characters in each class.
WIDTH = {"0": 10, "a": 6, "z": 20, "A": 26}
#: Background words stand alone and are too short for a candidate, so that keys don't count as words.
WORD = re.compile(r"(?<![A-Za-z0-9+/_=.-])[A-Za-z]{4,15}+(?![A-Za-z0-9+/_=-])")


def base_spans(text: str) -> dict[str, list[tuple[int, int]]]:
    """Plain secrets by kind."""
    low = text.lower()
    found: dict[str, list[tuple[int, int]]] = {k: [] for k in KINDS}
    if any(k in low for k in KEYWORDS):
        found["assign"] = [m.span() for m in ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 8]
    if "AKIA" in text:
        found["access"] = [m.span() for m in ACCESS.finditer(text) if m.end() - m.start() >= 16]
    found["hex"] = [m.span() for m in HEX.finditer(text)]
    return found


def credentials(text: str) -> list[tuple[str, str]]:
    """(format, value) of the plain secrets: what they are labelled as."""
    found = base_spans(text)
    out = [("hex", text[a:b]) for a, b in found["hex"]] + [("access", text[a:b]) for a, b in found["access"]]
    for a, b in found["assign"]:
        out.append(("assign", ASSIGN.match(text, a, b)[2]))
    return out


def symbol(char: str) -> str:
    """The class of a character: a-f apart, for hexadecimal formats."""
    if char.isdigit():
        return "0"
    if "a" <= char <= "f":
        return "a"
    if "a" <= char <= "z":
        return "z"
    if "A" <= char <= "Z":
        return "A"
    return char


class Automaton:
    """A probabilistic automaton inferred from strings by state merging."""

    def __init__(self, step: list[dict[str, int]], pass_count: list[int], moves: list[dict[str, int]], ends: list[int]):
        self.step, self.seen, self.moves, self.ends = step, pass_count, moves, ends

    @classmethod
    def tree(cls, strings) -> Automaton:
        self = cls([{}], [0], [{}], [0])
        for string in strings:
            state = 0
            self.seen[0] += 1
            for c in string[:DEPTH]:
                if c not in self.step[state]:
                    self.step[state][c] = len(self.step)
                    self.step.append({})
                    self.seen.append(0)
                    self.moves.append({})
                    self.ends.append(0)
                self.moves[state][c] = self.moves[state].get(c, 0) + 1
                state = self.step[state][c]
                self.seen[state] += 1
            self.ends[state] += 1
        return self

    def _differ(self, f1: int, n1: int, f2: int, n2: int, alpha: float) -> bool:
        if not n1 or not n2:
            return False
        bound = math.sqrt(0.5 * math.log(2 / alpha)) * (1 / math.sqrt(n1) + 1 / math.sqrt(n2))
        return abs(f1 / n1 - f2 / n2) > bound

    def compatible(self, p: int, q: int, alpha: float) -> bool:
        """Whether the continuations of two states, and of all that follows, agree."""
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            if self._differ(self.ends[p], self.seen[p], self.ends[q], self.seen[q], alpha):
                return False
            for c in {*self.moves[p], *self.moves[q]}:
                if self._differ(self.moves[p].get(c, 0), self.seen[p], self.moves[q].get(c, 0), self.seen[q], alpha):
                    return False
                if c in self.step[p] and c in self.step[q]:
                    todo.append((self.step[p][c], self.step[q][c]))
        return True

    def fold(self, p: int, q: int) -> None:
        """Add the subtree of ``q`` to state ``p``."""
        todo = [(p, q)]
        while todo:
            p, q = todo.pop()
            self.seen[p] += self.seen[q]
            self.ends[p] += self.ends[q]
            for c, n in self.moves[q].items():
                self.moves[p][c] = self.moves[p].get(c, 0) + n
                if c in self.step[p]:
                    todo.append((self.step[p][c], self.step[q][c]))
                else:
                    self.step[p][c] = self.step[q][c]

    @classmethod
    def infer(cls, strings, alpha: float = ALPHA) -> Automaton:
        """Merge compatible states: settled ones (red) take in their successors (blue), in order of settling."""
        self = cls.tree(sorted(strings))
        red = [0]
        while True:
            settled = set(red)
            blue = ((p, c) for p in red for c in sorted(self.step[p]) if self.step[p][c] not in settled)
            p, c = next(blue, (None, None))
            if p is None:
                return self._compact(red)
            q = self.step[p][c]
            into = next((r for r in red if self.compatible(r, q, alpha)), None)
            if into is None:
                red.append(q)
            else:
                self.step[p][c] = into
                self.fold(into, q)

    def _compact(self, red: list[int]) -> Automaton:
        number = {q: i for i, q in enumerate(red)}
        return Automaton(
            [{c: number[q] for c, q in self.step[p].items()} for p in red],
            [self.seen[p] for p in red], [self.moves[p] for p in red], [self.ends[p] for p in red],
        )

    def steps(self, string: str, alphabet: int = 12) -> list[float]:
        """Logarithm of the likelihood of each character; unseen moves have a small share and start anew."""
        out, state = [], 0
        for c in string:
            out.append(math.log((self.moves[state].get(c, 0) + 0.05) / (self.seen[state] + 0.05 * alphabet)))
            state = self.step[state].get(c, 0)
        return out

    def score(self, string: str, alphabet: int = 12) -> float:
        """Logarithm of the likelihood per character."""
        return sum(self.steps(string, alphabet)) / len(string) if string else -math.inf


def classes(value: str) -> str:
    return "".join(map(symbol, value))


class Words:
    """Likelihood of runs as words, numbers and signs; words by the pairs of letters in a sample."""

    def __init__(self, words: list[str]):
        self.pairs: dict[tuple[str, str], int] = {}
        self.first: dict[str, int] = {}
        for word in words:
            low = word.lower()
            for pair in zip(" " + low, low):
                self.pairs[pair] = self.pairs.get(pair, 0) + 1
                self.first[pair[0]] = self.first.get(pair[0], 0) + 1

    def _letter(self, before: str, c: str) -> float:
        return math.log((self.pairs.get((before, c), 0) + 0.5) / (self.first.get(before, 0) + 13))

    def steps(self, value: str) -> list[float]:
        """Logarithm of the likelihood of each character."""
        out, last = [], ""
        for part in PART.findall(value):
            if part[0].isdigit():
                own = [MORE_DIGITS - math.log(10)] * len(part)
                own[0] += NEW_PART
            elif part[0].isalpha():
                low = part.lower()
                own = [max(self._letter(b, c), SAME if b == c else -math.inf) for b, c in zip(" " + low, low)]
                own[0] += NEW_PART
            else:
                own = [SAME if part == last else NEW_SIGN]
            out += own
            last = part
        return out


class Formats:
    """One automaton for each credential format, and the words they are told from."""

    def __init__(self, labelled: list[tuple[str, str]], alpha: float = ALPHA):
        own: dict[str, list[str]] = {}
        for kind, value in labelled:
            own.setdefault(kind, []).append(value)
        self.words = Words(own.pop("word", []))
        self.formats = {k: Automaton.infer(map(classes, v), alpha) for k, v in sorted(own.items())}

    def ratios(self, value: str) -> list[list[float]]:
        """For each format how much likelier every character is under it than as words (logarithm)."""
        form, words = classes(value), self.words.steps(value)
        widths = [math.log(WIDTH.get(c, 1)) for c in form]
        return [[f - w - p for f, w, p in zip(a.steps(form), widths, words)] for a in self.formats.values()]

    def likeness(self, value: str) -> float:
        """How much likelier ``value`` is as a credential than as words, per character (logarithm)."""
        return max((sum(r) / len(r) for r in self.ratios(value) if r), default=-math.inf)

    def stretches(self, value: str, margin: float) -> list[tuple[int, int]]:
        """Stretches of ``value`` that are likelier as a credential by the margin: all of it, or the best ones."""
        found, todo = [], [(0, len(value))]
        while todo:
            start, end = todo.pop()
            if end - start < LEAST:
                continue
            part = value[start:end]
            ratios = self.ratios(part)
            if any(sum(r) > margin * len(r) for r in ratios):
                found.append((start, end))
                continue
            a, b = max((best_stretch(r, margin) for r in ratios), key=lambda s: s[2], default=(0, 0, 0.0))[:2]
            while 0 < a < b and part[a - 1].isalnum():
                a -= 1
            while a < b < len(part) and part[b].isalnum():
                b += 1
            if b - a >= LEAST:
                found.append((start + a, start + b))
                todo += [(start, start + a), (start + b, end)]
        return sorted(found)


def best_stretch(ratios: list[float], margin: float) -> tuple[int, int, float]:
    """(start, end, excess) of the stretch of ``LEAST`` or more whose sum exceeds the margin by most; empty if none does."""
    total, sums, low, at, best = 0.0, [0.0], 0.0, 0, (0, 0, 0.0)
    for i, r in enumerate(ratios, 1):
        total += r - margin
        sums.append(total)
        if i >= LEAST:
            if sums[i - LEAST] < low:
                low, at = sums[i - LEAST], i - LEAST
            if total - low > best[2]:
                best = (at, i, total - low)
    return best


def mixed(value: str) -> bool:
    """Whether letters and digits alternate.  The scan does not ask for it: the likelihood alone decides."""
    kinds = re.findall(r"[0-9]+|[A-Za-z]+", value)
    digits = sum(c.isdigit() for c in value)
    return len(kinds) >= 4 and digits * 8 >= len(value) and digits < len(value) - 2


def added_spans(text: str, base: dict[str, list[tuple[int, int]]], formats: Formats, margin: float = MARGIN) -> list[tuple[int, int]]:
    """Stretches of candidates that look like credentials; plain secrets are cut out of the candidates first."""
    taken = sorted(s for spans in base.values() for s in spans)
    found, k = [], 0
    for m in CANDIDATE.finditer(text):
        at, end = m.span()
        while k < len(taken) and taken[k][1] <= at:
            k += 1
        i = k
        while at < end:
            while i < len(taken) and taken[i][1] <= at:
                i += 1
            stop = min(end, taken[i][0]) if i < len(taken) else end
            if stop - at >= LEAST:
                found += [(at + a, at + b) for a, b in formats.stretches(text[at:stop], margin)]
            at = max(stop, taken[i][1]) if i < len(taken) else end
    return found


def spelled_out(spans: list[tuple[str, int, int]]) -> str:
    """kind:start:end by start, then kind as listed (found ones last), joined by commas."""
    order = {k: i for i, k in enumerate((*KINDS, "format"))}
    return ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(spans, key=lambda s: (s[1], order[s[0]])))


def _label_rows(batches):
    for batch in batches:
        kinds, values = [], []
        for value in batch.column("text"):
            text = (value.as_py() or b"").decode("utf-8", "replace")
            found = credentials(text)
            kinds += [k for k, _ in found]
            values += [v for _, v in found]
            word = WORD.search(text, len(text) // 2)  # one word for each text
            if word:
                kinds.append("word")
                values.append(word.group()[: 4 * DEPTH])
        yield pa.RecordBatch.from_arrays([pa.array(kinds, pa.string()), pa.array(values, pa.string())], names=["kind", "value"])


def labelled_sample(docs: DataFrame, sample: int = SAMPLE) -> list[tuple[str, str]]:
    """At most ``sample`` distinct values of each kind, those with the smallest hashes; they alone reach the driver."""
    found = docs.select(utf8("text").alias("text")).mapInArrow(_label_rows, "kind string, value string")
    found = materialize(found.distinct(), "credentials")
    out = []
    for kind in ("word", *KINDS):
        rows = found.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(sample).collect()
        out += [(r.kind, r.value) for r in rows]
    return out


SCHEMA = pa.schema(
    [("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("base_sha256", pa.string()),
     ("spans", pa.string()), ("n_added", pa.int64())]
)
#: The formats that a worker used last, by the key of their sample.
_BUILT: dict[str, Formats] = {}


def _formats(key: str, sample) -> Formats:
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = Formats(sample.value)
    return _BUILT[key]


def _all_spans(text: str, formats: Formats, margin: float):
    base = base_spans(text)
    return base, added_spans(text, base, formats, margin)


def _scan_rows(sample, margin: float):
    key = uuid4().hex

    def task(batches):
        formats = _formats(key, sample)
        for batch in batches:
            rows = []
            for value in batch.column("text"):
                base, added = _all_spans((value.as_py() or b"").decode("utf-8", "replace"), formats, margin)
                spans = [(k, *s) for k in KINDS for s in base[k]]
                digest = hashlib.sha256(spelled_out(spans).encode()).hexdigest()
                spans_too = spelled_out(spans + [("format", *s) for s in added])
                rows.append((*(len(base[k]) for k in KINDS), digest, spans_too, len(added)))
            columns = list(zip(*rows)) or [()] * len(SCHEMA)
            arrays = [pa.array(c, f.type) for c, f in zip(columns, SCHEMA)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *arrays], names=["doc_id", *SCHEMA.names])

    return task


def find(docs: DataFrame, sample: int = SAMPLE, margin: float = MARGIN) -> DataFrame:
    """Secrets in ``text`` of every row: doc_id, counts of plain secrets by kind, the digest of their
    spans, all spans (those found by format too) and n_added, the number found by format.

    Null and empty texts have none.  A null ``doc_id`` is carried along, repeated rows get a row each, an
    empty table gives no rows, other columns are not read.  Without any labelled credential nothing is
    found by format.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(labelled_sample(docs, sample))
    rows = docs.select("doc_id", utf8("text").alias("text"))
    schema = T.StructType(
        [
            docs.select("doc_id").schema.fields[0],
            *[T.StructField(n, T.LongType()) for n in SCHEMA.names[:3]],
            T.StructField("base_sha256", T.StringType()),
            T.StructField("spans", T.StringType()),
            T.StructField("n_added", T.LongType()),
        ]
    )
    return rows.mapInArrow(_scan_rows(shipped, margin), schema)


def redacted(text: str, formats: Formats, margin: float = MARGIN, mask: str = "[SECRET]") -> str:
    """``text`` with every secret masked; of an assignment the value only."""
    base, added = _all_spans(text, formats, margin)
    spans = [*base["access"], *base["hex"], *added]
    for a, b in base["assign"]:
        spans.append(ASSIGN.match(text, a, b).span(2))
    parts, at = [], 0
    for a, b in sorted(spans):
        if a >= at:
            parts += [text[at:a], mask]
        at = max(at, b)
    return "".join([*parts, text[at:]])


def _redact_rows(sample, margin: float, flag: str):
    key = uuid4().hex

    def task(batches):
        formats = _formats(key, sample)
        for batch in batches:
            at, changed = batch.schema.get_field_index("text"), batch.schema.get_field_index(flag)
            old = batch.column(at).to_pylist()
            new = [None if t is None else redacted(t, formats, margin) for t in old]
            batch = batch.set_column(at, batch.schema.field(at), pa.array(new, batch.schema.field(at).type))
            yield batch.set_column(changed, batch.schema.field(changed), pa.array([a != b for a, b in zip(old, new)], pa.bool_()))

    return task


def mask_secrets(docs: DataFrame, sample: int = SAMPLE, margin: float = MARGIN) -> DataFrame:
    """``docs`` with the secrets of ``text`` masked; all rows and columns stay.

    ``n_chars``, if there, is counted anew for texts that changed.  Null texts stay null.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(labelled_sample(docs, sample))
    rest, flag, filler = free_names(docs, "rest", "changed", "filler")
    others = [c for c, name in zip(all_columns(docs), docs.columns) if name != "text"]
    packed = docs.select(F.struct(*others, F.lit(0).alias(filler)).alias(rest), F.col("text").cast("string").alias("text"), F.lit(False).alias(flag))
    out = packed.mapInArrow(_redact_rows(shipped, margin, flag), packed.schema)
    columns = []
    for name in docs.columns:
        value = F.col("text") if name == "text" else F.col(rest).getField(name)
        if name == "n_chars":
            value = F.when(F.col(flag), F.length("text").cast(docs.schema[name].dataType)).otherwise(value)
        columns.append(value.alias(name))
    return out.select(*columns)
