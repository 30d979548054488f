"""Secret scans: fixed patterns, then formats learned by grammar inference from what they label.

Credentials that the fixed patterns find are labelled by their pattern. From a bounded sample of them one probabilistic
automaton per label is inferred: a prefix tree of the samples, whose states are merged in breadth-first order when their
outgoing and ending frequencies are statistically compatible (Hoeffding bound, checked down the tree), else kept. Every
candidate, a run of credential characters with a letter and a digit, is then scored by how much likelier a character of it is
under an automaton than under the background of all candidates, and the likely ones are added to the spans.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from modelmon.llm.common import arrow_rows, fixed

# The base patterns and the least lengths of what they find.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
ASSIGN_LEAST, ACCESS_LEAST, HEX_LEAST = 8, 16, 32
KINDS = ("assign", "access", "hex")
KEYWORDS = ("passw", "secret", "token", "apikey", "api_key")
FORMAT = "format"

# A candidate: a run of these characters, this long, with a letter and a digit.
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
_HEX_RUN = re.compile(r"[0-9a-f]{32,}")
_DIGIT, _LETTER = re.compile(r"[0-9]"), re.compile(r"[A-Za-z]")
# Labelled credentials per label that an automaton is inferred from, taken by hash over the whole corpus.
SAMPLE = 1_000
# Characters of a credential that build the tree; later ones count towards its last states.
DEPTH = 64
ALPHA = 0.05
# Smoothing of a state's characters, and the gain per character (natural log) over the background that makes a secret.
SMOOTH = 0.05
GAIN = 0.4
# Characters of the background that are taken as any character at all, so that few candidates do not make their own rule.
UNIFORM = 500
ALPHABET = 66


def base_spans(text: str) -> list[tuple[str, int, int, str]]:
    """(kind, start, end, credential) of the fixed patterns, by start and then kind as listed."""
    found = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        found += [("assign", *m.span(), m[2]) for m in ASSIGN.finditer(text) if len(m[2]) >= ASSIGN_LEAST]
    if "AKIA" in text:
        found += [("access", *m.span(), m[0]) for m in ACCESS.finditer(text) if len(m[0]) >= ACCESS_LEAST]
    # A run of 32 or more is a whole run of HEX, which takes all it can.
    found += [("hex", *m.span(), m[0]) for m in _HEX_RUN.finditer(text)]
    return sorted(found, key=lambda s: (s[1], KINDS.index(s[0])))


def candidates(text: str) -> list[tuple[int, int, str]]:
    return [(*m.span(), m[0]) for m in CANDIDATE.finditer(text) if _DIGIT.search(m[0]) and _LETTER.search(m[0])]


def free_of(found: list[tuple[int, int, str]], taken: list[tuple[str, int, int, str]]) -> list[tuple[int, int, str]]:
    """The candidates that touch no span of ``taken`` (by start). Candidates do not overlap, so one walk over both will do."""
    out, at, reach = [], 0, -1
    for start, end, value in found:
        while at < len(taken) and taken[at][1] < end:
            reach = max(reach, taken[at][2])
            at += 1
        if reach <= start:
            out.append((start, end, value))
    return out


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


class Automaton:
    """A probabilistic automaton inferred from strings. ``next[state][character]`` is (state, count)."""

    def __init__(self, strings: list[str]) -> None:
        self.next: list[dict[str, list[int]]] = [{}]
        self.total, self.ends = [0], [0]
        for s in strings:
            self._insert(s[:DEPTH])
        self._merge()

    def _insert(self, s: str) -> None:
        state = 0
        for c in s:
            self.total[state] += 1
            if c not in self.next[state]:
                self.next[state][c] = [len(self.next), 0]
                self.next.append({})
                self.total.append(0)
                self.ends.append(0)
            self.next[state][c][1] += 1
            state = self.next[state][c][0]
        self.total[state] += 1
        self.ends[state] += 1

    def _differ(self, x: int, n: int, y: int, m: int) -> bool:
        return abs(x / n - y / m) > math.sqrt(0.5 * math.log(2 / ALPHA)) * (1 / math.sqrt(n) + 1 / math.sqrt(m))

    def _compatible(self, a: int, b: int) -> bool:
        """Whether the states' frequencies, and those of the states below b, could come from one distribution."""
        stack, seen = [(a, b)], 0
        while stack:
            a, b = stack.pop()
            n, m = self.total[a], self.total[b]
            if not n or not m:
                continue
            if self._differ(self.ends[a], n, self.ends[b], m):
                return False
            for c in self.next[a].keys() | self.next[b].keys():
                x, y = self.next[a].get(c), self.next[b].get(c)
                if self._differ(x[1] if x else 0, n, y[1] if y else 0, m):
                    return False
                # Counts of a few strings reject nothing below here.
                if x and y and min(self.total[x[0]], self.total[y[0]]) > 4:
                    stack.append((x[0], y[0]))
        return True

    def _fold(self, a: int, b: int) -> None:
        """Add the subtree b to state a."""
        stack = [(a, b)]
        while stack:
            a, b = stack.pop()
            if a == b:
                continue
            self.total[a] += self.total[b]
            self.ends[a] += self.ends[b]
            for c, (child, n) in list(self.next[b].items()):
                if c in self.next[a]:
                    self.next[a][c][1] += n
                    stack.append((self.next[a][c][0], child))
                else:
                    self.next[a][c] = [child, n]

    def _merge(self) -> None:
        kept = [0]
        queue = [(0, c) for c in sorted(self.next[0])]
        while queue:
            # The blue state with most strings first: its merge decides the most.
            queue.sort(key=lambda e: -self.next[e[0]][e[1]][1])
            parent, c = queue.pop(0)
            state = self.next[parent][c][0]
            if state in kept:
                continue
            for red in kept:
                if self._compatible(red, state):
                    self.next[parent][c][0] = red
                    self._fold(red, state)
                    break
            else:
                kept.append(state)
            queue = [(r, c) for r in kept for c in sorted(self.next[r]) if self.next[r][c][0] not in kept]
        number = {s: i for i, s in enumerate(kept)}
        self.next = [{c: [number[t], n] for c, (t, n) in self.next[s].items()} for s in kept]
        self.total, self.ends = [self.total[s] for s in kept], [self.ends[s] for s in kept]

    def per_character(self, s: str) -> float:
        """The mean log probability of the characters of s; an unknown character keeps the state."""
        state, total = 0, 0.0
        for c in s:
            n = self.total[state] - self.ends[state]
            step = self.next[state].get(c)
            total += math.log(((step[1] if step else 0) + SMOOTH) / (n + SMOOTH * ALPHABET))
            state = step[0] if step else state
        return total / max(1, len(s))


class Formats:
    """The automata by label, and the background: the candidates' characters after their character class."""

    def __init__(self, labelled: dict[str, list[str]], background: dict[tuple[str, str], int]) -> None:
        self.automata = {k: Automaton(v) for k, v in sorted(labelled.items()) if len(v) >= 8}
        self.pairs = background
        self.before: dict[str, int] = defaultdict(int)
        for (a, _), n in background.items():
            self.before[a] += n

    def gain(self, s: str) -> float:
        """How much likelier (log per character) the best automaton finds s than the background does."""
        if not self.automata:
            return -math.inf
        classes = ["^", *map(character_class, s)]
        plain = sum(
            math.log((self.pairs.get((a, c), 0) + UNIFORM / ALPHABET) / (self.before.get(a, 0) + UNIFORM)) for a, c in zip(classes, s)
        )
        return max(a.per_character(s) for a in self.automata.values()) - plain / max(1, len(s))


def character_class(c: str) -> str:
    return "0" if c.isdigit() else "a" if c.islower() else "A" if c.isupper() else c


def _found(docs: DataFrame) -> DataFrame:
    """(doc_id, base, rest) per document: the base spans with their credentials, and the candidates outside them."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("value", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            base, rest = [], []
            for text in batch.column("text").to_pylist():
                mine = base_spans(text or "")
                base.append([dict(zip(("kind", "start", "end", "value"), s)) for s in mine])
                free = free_of(candidates(text or ""), mine)
                rest.append([{"kind": FORMAT, "start": s, "end": e, "value": v} for s, e, v in free])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(base, pa.list_(span)), pa.array(rest, pa.list_(span))], names=["doc_id", "base", "rest"]
            )

    kind = "array<struct<kind: string, start: bigint, end: bigint, value: string>>"
    return fixed(docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, base {kind}, rest {kind}"), "candidates")


def formats(found: DataFrame) -> Formats:
    """Automata from SAMPLE distinct credentials per label (smallest hashes), background counts over all candidates."""
    labelled = {}
    values = found.select(F.explode("base").alias("s")).select("s.kind", "s.value").distinct()
    for kind in KINDS:
        rows = values.where(F.col("kind") == kind).orderBy(F.xxhash64("value"), "value").limit(SAMPLE).collect()
        labelled[kind] = [r.value for r in rows]

    def pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple[str, str], int] = defaultdict(int)
        for batch in batches:
            for spans in batch.column("rest").to_pylist():
                for s in spans or ():
                    for a, c in zip(["^", *map(character_class, s["value"])], s["value"]):
                        counts[a, c] += 1
        keys = list(counts)
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[i] for k in keys], pa.string()) for i in (0, 1)] + [pa.array([counts[k] for k in keys], pa.int64())], names=["a", "c", "n"]
        )

    with arrow_rows(found.sparkSession):
        rows = found.select("rest").mapInArrow(pairs, "a string, c string, n long").groupBy("a", "c").agg(F.sum("n").alias("n")).collect()
    return Formats(labelled, {(r.a, r.c): r.n for r in rows})


def secrets(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): n_assign, n_access, n_hex, base_sha256, spans, n_format.

    Spans are kind:start:end in code points, end exclusive, by start and then kind; those of kind "format" are added by
    the learned formats and never touch a base span. Null and empty texts have none. Repeated rows come out repeated, an
    empty table gives an empty one, further columns are ignored. Fewer than eight labelled credentials of a kind give no
    automaton for it.
    """
    found = _found(docs.select("doc_id", F.col("text").cast("string").alias("text")))
    known = found.sparkSession.sparkContext.broadcast(formats(found))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, digests, spans, added = {k: [] for k in KINDS}, [], [], []
            for base, rest in zip(batch.column("base").to_pylist(), batch.column("rest").to_pylist()):
                mine = [(s["kind"], s["start"], s["end"]) for s in base]
                for k in KINDS:
                    counts[k].append(sum(s[0] == k for s in mine))
                digests.append(hashlib.sha256(joined(mine).encode()).hexdigest())
                more = [(FORMAT, s["start"], s["end"]) for s in rest if known.value.gain(s["value"]) >= GAIN]
                added.append(len(more))
                spans.append(joined(sorted(mine + more, key=lambda s: (s[1], (*KINDS, FORMAT).index(s[0])))))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(digests), pa.array(spans), pa.array(added, pa.int64())],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_format"],
            )

    kind = found.schema["doc_id"].dataType.simpleString()
    return fixed(
        found.mapInArrow(run, f"doc_id {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_format long"), "secrets"
    )
