"""Secret scans: all rules in one automaton, one pass over the bytes.

Each rule's pattern becomes a nondeterministic automaton over bytes; subset construction joins them
into one, minimisation by partition refinement folds equal states, and the result is a flat
transition array over byte classes. A pass over a text's bytes visits one state per byte and tells
for every rule where its leftmost matches end. Greedy matches are kept apart as a regular-expression
search would: while a match of a rule grows, later starts of that rule are dropped, and when it can
grow no further the rule starts anew. A second, reversed automaton of the rule finds the start.

Spans are code points, end exclusive, and cover the whole match (key and value for ``assign``). Rules
after the first three are extensions of ours.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_ALNUM = "A-Za-z0-9"


@dataclass(frozen=True)
class Rule:
    """``parts``: sequence of (alternatives or a character class, times), see ``_build``."""

    name: str
    parts: tuple
    least: int = 0
    value: str = ""  # characters of the value that ends a match; ``least`` counts those if given


# The three base rules.
RULES = (
    Rule("assign", (("words", ("password", "passwd", "secret", "token", "apikey", "api_key")), ("class", "\"'", "?"), ("class", " ", "*"), ("class", ":=", "1"), ("class", " ", "*"), ("class", "\"'", "?"), ("class", _ALNUM + "+/_.=\\-", "+")), 6, _ALNUM + "+/_.=\\-"),
    Rule("access", (("exact", ("AKIA",)), ("class", "A-Z0-9", "+")), 20),
    Rule("hex", (("class", "0-9a-f", 24), ("class", "0-9a-f", "*")), 24),
    # extensions
    Rule("forge", (("exact", ("ghp_", "gho_", "ghu_", "ghs_", "ghr_")), ("class", _ALNUM, "+")), 40),
    Rule("pem", (("exact", ("-----BEGIN ",)), ("class", "A-Z ", "*"), ("exact", ("PRIVATE KEY-----",)))),
)


def _members(spec: str) -> frozenset[int]:
    return frozenset(i for i in range(256) if re.fullmatch(f"[{spec}]".encode(), bytes([i])))


class _Nfa:
    """Epsilon-free positions: edges[state] = [(bytes, state)]; built left to right."""

    def __init__(self):
        self.edges: list[list[tuple[frozenset[int], int]]] = []

    def state(self) -> int:
        self.edges.append([])
        return len(self.edges) - 1

    def add(self, rule: Rule) -> tuple[int, set[int]]:
        start = self.state()
        ends = {start}
        for part in rule.parts:
            if part[0] == "class":
                chars, times = _members(part[1]), part[2]
                if times == "?":
                    to = self.state()
                    for e in ends:
                        self.edges[e].append((chars, to))
                    ends = ends | {to}
                elif times == "*":
                    to = self.state()
                    for e in [*ends, to]:
                        self.edges[e].append((chars, to))
                    ends = ends | {to}
                else:
                    for _ in range(times if isinstance(times, int) else 1):
                        to = self.state()
                        for e in ends:
                            self.edges[e].append((chars, to))
                        ends = {to}
                    if times == "+":
                        self.edges[to].append((chars, to))
            else:
                after = set()
                for word in part[1]:
                    at = ends
                    for c in word.encode():
                        chars = frozenset({c, c ^ 32} if part[0] == "words" and chr(c).isalpha() else {c})
                        to = self.state()
                        for e in at:
                            self.edges[e].append((chars, to))
                        at = {to}
                    after |= at
                ends = after
        return start, ends


@dataclass
class Automaton:
    """``step[state * classes + class]`` is the next state times classes; ``accepts[state]`` rule bits."""

    classes: int
    class_of: bytes
    step: list[int]
    accepts: list[int]
    start: int
    first_accepting: int
    dead: int  # the state that no byte leads out of and that accepts nothing, or -1


def _determinise(edges, starts: list[int], ends: list[set[int]], floating: bool) -> Automaton:
    """Subset construction of all rules at once, minimised.

    ``floating``: a match may start anywhere. In a state that accepts a rule, that rule's other
    threads are dropped; on leaving it the rule has only its start state again.
    """
    owner: dict[int, int] = {}
    for r, s in enumerate(starts):
        stop = starts[r + 1] if r + 1 < len(starts) else len(edges)
        owner.update(dict.fromkeys(range(s, stop), r))
    kinds: dict[tuple, int] = {}
    class_of = bytearray(256)
    every = sorted({c for out in edges for c, _ in out}, key=sorted)
    for b in range(256):
        class_of[b] = kinds.setdefault(tuple(b in c for c in every), len(kinds))
    sample = [class_of.index(k) for k in range(len(kinds))]
    final = {s: r for r, es in enumerate(ends) for s in es}
    step_of = [[tuple(t for c, t in out if b in c) for b in sample] for out in edges]

    def settle(threads: set[int], before: int) -> frozenset[int]:
        if not floating:
            return frozenset(threads)
        accepted = {final[s] for s in threads if s in final}
        out = set()
        for s in threads:
            if owner[s] not in accepted or s in final:
                out.add(s)
        return frozenset(out | {starts[r] for r in range(len(starts)) if r not in accepted})

    begin = settle({starts[r] for r in range(len(starts))}, 0)
    number, order, table = {begin: 0}, [begin], []
    for at in order:
        row = []
        growing = {final[s] for s in at if s in final}
        for k in range(len(sample)):
            to = {t for s in at for t in step_of[s][k]}
            if floating:
                # a rule that stops growing at this byte may start a new match with it
                for r in growing - {owner[t] for t in to}:
                    to |= set(step_of[starts[r]][k])
            to = settle(to, 0)
            if to not in number:
                number[to] = len(order)
                order.append(to)
            row.append(number[to])
        table.append(row)
    accepts = [sum({1 << final[s] for s in at if s in final}) for at in order]
    # minimisation: split blocks until members agree on the blocks of all their successors
    grid = np.array(table)
    block = np.unique(np.array(accepts), return_inverse=True)[1].reshape(-1)
    while True:
        keys = np.column_stack([block, block[grid]])
        new = np.unique(keys, axis=0, return_inverse=True)[1].reshape(-1)
        if new.max() == block.max():
            break
        block = new
    first = [int(np.flatnonzero(block == k)[0]) for k in range(block.max() + 1)]
    ranked = sorted(range(len(first)), key=lambda k: accepts[first[k]] != 0)  # accepting states last
    place = {k: i for i, k in enumerate(ranked)}
    classes = len(sample)
    step = [place[block[grid[first[k], c]]] * classes for k in ranked for c in range(classes)]
    flags = [accepts[first[k]] for k in ranked]
    dead = next((k * classes for k, f in enumerate(flags) if not f and set(step[k * classes : (k + 1) * classes]) == {k * classes}), -1)
    first = next((i for i, f in enumerate(flags) if f), len(flags)) * classes
    return Automaton(classes, bytes(class_of), step, flags, place[block[0]] * classes, first, dead)


class Scanner:
    """All rules compiled; ``spans(text)`` gives ``(rule, start, end)``."""

    def __init__(self, rules: tuple[Rule, ...] = RULES):
        self.rules = rules
        nfa, starts, ends = _Nfa(), [], []
        for rule in rules:
            s, e = nfa.add(rule)
            starts.append(s)
            ends.append(e)
        self.forward = _determinise(nfa.edges, starts, ends, True)
        self.backward = []
        for r in range(len(rules)):
            low, high = starts[r], starts[r + 1] if r + 1 < len(rules) else len(nfa.edges)
            size = high - low
            back: list[list[tuple[frozenset[int], int]]] = [[] for _ in range(size + 1)]
            for s in range(low, high):
                for chars, t in nfa.edges[s]:
                    back[t - low + 1].append((chars, s - low + 1))
                    if t in ends[r]:
                        back[0].append((chars, s - low + 1))
            self.backward.append(_determinise(back, [0], [{1}], False))
        self.value_of = [_members(rule.value) if rule.value else None for rule in rules]

    def _start(self, rule: int, data: bytes, first_end: int, floor: int) -> int:
        """Leftmost start, not before ``floor``, of a match of the rule that ends at ``first_end``."""
        auto, at, best = self.backward[rule], self.backward[rule].start, first_end
        for i in range(first_end - 1, floor - 1, -1):
            at = auto.step[at + auto.class_of[data[i]]]
            if at == auto.dead:
                break
            flag = auto.accepts[at // auto.classes]
            if flag:
                best = i
        return best

    def byte_spans(self, data: bytes) -> list[tuple[int, int, int]]:
        """Spans ``(start, rule number, end)`` in bytes, in order."""
        auto = self.forward
        step, at, accepting, classes = auto.step, auto.start, auto.first_accepting, auto.classes
        open_at: dict[int, int] = {}  # rule: where its growing match first ended
        floor: dict[int, int] = {}
        out = []
        flags = 0
        for i, c in enumerate(data.translate(auto.class_of)):
            at = step[at + c]
            if at >= accepting or flags:
                now = auto.accepts[at // classes]
                if now != flags:
                    for r in range(len(self.rules)):
                        bit = 1 << r
                        if flags & bit and not now & bit:
                            self._close(r, data, open_at.pop(r), i, floor, out)
                        elif now & bit and not flags & bit:
                            open_at[r] = i + 1
                    flags = now
        for r in sorted(open_at):
            self._close(r, data, open_at[r], len(data), floor, out)
        return sorted(out)

    def _close(self, r, data, first_end, end, floor, out):
        start = self._start(r, data, first_end, floor.get(r, 0))
        floor[r] = end
        size = end - start
        if (chars := self.value_of[r]) is not None:
            # the value begins where the first match ended less one character
            size = end - first_end + 1
        if size >= self.rules[r].least:
            out.append((start, r, end))

    def spans(self, text: str | None) -> list[tuple[str, int, int]]:
        """Spans ``(rule, start, end)`` in code points, by start, then rule order."""
        if not text:
            return []
        data = text.encode("utf-8", "surrogatepass")
        found = self.byte_spans(data)
        if len(data) == len(text):
            return [(self.rules[r].name, s, e) for s, r, e in found]
        marks, at, chars = {}, 0, 0
        for p in sorted({x for s, _, e in found for x in (s, e)}):
            chars += len(data[at:p].decode("utf-8", "surrogatepass"))
            marks[p], at = chars, p
        return [(self.rules[r].name, marks[s], marks[e]) for s, r, e in found]


def redact(text: str | None, spans: list[tuple[str, int, int]]) -> str | None:
    """The text with every span replaced by its rule's name in brackets; overlaps become one."""
    if not spans:
        return text
    out, at = [], 0
    merged: list[list] = []
    for rule, s, e in spans:
        if merged and s < merged[-1][2]:
            merged[-1][2] = max(merged[-1][2], e)
        else:
            merged.append([rule, s, e])
    for rule, s, e in merged:
        out += [text[at:s], f"[{rule}]"]
        at = e
    return "".join([*out, text[at:]])


def _digests(scanner: Scanner):
    names = [r.name for r in scanner.rules]

    def run(batches):
        for batch in batches:
            found = [scanner.spans(x) for x in batch.column("text").to_pylist()]
            told = [[f"{k}:{s}:{e}" for k, s, e in spans] for spans in found]
            base = [",".join(t for t, (k, _, _) in zip(x, spans, strict=True) if k in names[:3]) for x, spans in zip(told, found, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"),
                    *(pa.array([sum(k == n for k, _, _ in spans) for spans in found], pa.int64()) for n in names[:3]),
                    pa.array([hashlib.sha256(x.encode()).hexdigest() for x in base], pa.string()),
                    pa.array([",".join(x) for x in told], pa.string()),
                ],
                names=["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"],
            )

    return run


def secret_spans(documents: DataFrame) -> DataFrame:
    """Secrets of every text: ``doc_id, n_assign, n_access, n_hex, base_sha256, spans``, a row per row.

    Null and empty texts have no spans (counts of zero, the digest of the empty string). A null doc_id
    is carried through, repeated rows are scanned each, other columns are ignored. An empty table gives
    no rows. Memory is that of one text and one batch, whatever the length of a text.
    """
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        _digests(Scanner()), "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    )


def redacted(documents: DataFrame) -> DataFrame:
    """``documents`` with the secrets in ``text`` replaced and ``n_chars`` counted again, same columns."""
    scanner = Scanner()

    @F.pandas_udf("string")
    def clean(texts):
        return texts.map(lambda x: redact(x, scanner.spans(x)) if x else x)

    out = documents.withColumn("text", clean("text"))
    if "n_chars" in documents.columns:
        kind = dict(documents.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("n_chars").isNotNull(), F.length("text").cast(kind)))
    return out.select(*documents.columns)
