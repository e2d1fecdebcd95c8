"""Secret scans with one deterministic automaton for all rules.

The rules' regexes (literals, classes, groups, alternatives, ``? * + {m,n}``)
are compiled together: a non-deterministic automaton that may start a match
anywhere, subset construction over byte classes, minimisation. Each state
carries the set of rules that have a match ending there. One pass over a
text's bytes gives the ends; the rule's reversed automaton then walks back from
an end to the leftmost start that does not reach into the rule's previous span.

A span shorter than its rule's least length does not count. The base rules are
leftmost, non-overlapping and are filtered by length afterwards, so a failing
match can use up a place where the automaton sees a secret. Both are kept: in a
text in which the automaton met a base rule, a second combined automaton, of the
reversed base rules, passes over the bytes from the end and marks every place
where a base match can start. From the leftmost mark the rule's forward automaton
walks to the longest end, the next mark behind it follows, and short matches
are dropped at last. Every span of the first automaton is added.

Defined cases: null or empty text has no spans; each row is judged alone, so
rows with equal or null doc_id do not mix; an empty table gives an empty
result; only ``doc_id`` and ``text`` are used, so other columns cannot clash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate
from operator import getitem

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from salesmart.llm.textkit import workers_ready


def _either(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


_KEYWORD = "(" + "|".join(_either(w) for w in ("password", "passwd", "secret", "token")) + "|" + _either("api") + "_?" + _either("key") + ")"
_ASSIGN = _KEYWORD + r"""["']?\x20*[:=]\x20*["']?"""
_VALUE = "[A-Za-z0-9+/_.=-]"

#: kind: (base regex, group whose length counts, least length).
BASE_RULES = {
    "assign": (_ASSIGN + f"({_VALUE}+)", 2, 6),
    "access": ("AKIA[A-Z0-9]+", 0, 20),
    "hex": ("[0-9a-f]+", 0, 24),
}
#: What comes before group 2 of a base rule. None of the base rules can begin its
#: group, or end, in two ways from one start, so longest is what a regex takes.
HEADS = {"assign": _ASSIGN}
#: kind: (what the automaton looks for, least length of a span); the base kinds
#: first, in their order. Long runs are counted by the least length, not by
#: states: counters of several rules would multiply each other's states.
RULES = {
    "assign": (_ASSIGN + _VALUE + "{6,}", 0),
    "access": ("AKIA[A-Z0-9]{4,}", 20),
    "hex": ("[0-9a-f]{6,}", 24),
    "pem": ("-----BEGIN [A-Z ]*PRIVATE KEY-----", 0),
    "github": ("gh[opsur]_[A-Za-z0-9]{4,}", 40),
    "slack": ("xox[abprs]-[A-Za-z0-9-]{4,}", 20),
}

# --- regex to automaton -------------------------------------------------

_ANY = frozenset(range(256))


class _Parser:
    """A regex as nested tuples: ("set", bytes), ("seq", parts), ("alt",
    parts), ("rep", part, least, most or None)."""

    def __init__(self, pattern: str):
        self.text, self.at = pattern, 0

    def parse(self):
        node = self.alternatives()
        if self.at != len(self.text):
            raise ValueError(f"unexpected {self.text[self.at]!r} at {self.at} in {self.text!r}")
        return node

    def peek(self) -> str:
        return self.text[self.at:self.at + 1]

    def take(self) -> str:
        self.at += 1
        return self.text[self.at - 1]

    def alternatives(self):
        parts = [self.sequence()]
        while self.peek() == "|":
            self.take()
            parts.append(self.sequence())
        return parts[0] if len(parts) == 1 else ("alt", parts)

    def sequence(self):
        parts = []
        while self.peek() and self.peek() not in "|)":
            parts.append(self.repeated(self.atom()))
        return ("seq", parts)

    def repeated(self, node):
        while self.peek() and self.peek() in "?*+{":
            c = self.take()
            if c == "{":
                end = self.text.index("}", self.at)
                least, _, most = self.text[self.at:end].partition(",")
                bounds = (int(least), int(most) if most else (None if "," in self.text[self.at:end] else int(least)))
                self.at = end + 1
            else:
                bounds = {"?": (0, 1), "*": (0, None), "+": (1, None)}[c]
            node = ("rep", node, *bounds)
        return node

    def atom(self):
        c = self.take()
        if c == "(":
            node = self.alternatives()
            if self.take() != ")":
                raise ValueError(f"group not closed in {self.text!r}")
            return node
        if c == "[":
            return ("set", self.members())
        if c == ".":
            return ("set", _ANY - {10})
        return ("set", frozenset([self.escaped() if c == "\\" else ord(c)]))

    def escaped(self) -> int:
        c = self.take()
        if c == "x":
            self.at += 2
            return int(self.text[self.at - 2:self.at], 16)
        return {"n": 10, "t": 9, "r": 13}.get(c, ord(c))

    def members(self) -> frozenset:
        negated = self.peek() == "^"
        if negated:
            self.take()
        found: set[int] = set()
        while self.peek() != "]":
            c = self.take()
            low = high = self.escaped() if c == "\\" else ord(c)
            if self.peek() == "-" and self.text[self.at + 1:self.at + 2] != "]":
                self.take()
                c = self.take()
                high = self.escaped() if c == "\\" else ord(c)
            found.update(range(low, high + 1))
        self.take()
        return _ANY - found if negated else frozenset(found)


def _reversed(node):
    if node[0] == "seq":
        return ("seq", [_reversed(x) for x in reversed(node[1])])
    if node[0] == "alt":
        return ("alt", [_reversed(x) for x in node[1]])
    if node[0] == "rep":
        return ("rep", _reversed(node[1]), *node[2:])
    return node


class _Nfa:
    def __init__(self):
        self.steps: list[list[tuple[frozenset, int]]] = []
        self.free: list[list[int]] = []

    def state(self) -> int:
        self.steps.append([])
        self.free.append([])
        return len(self.steps) - 1

    def add(self, node, start: int) -> int:
        """Builds the node from ``start``; returns its end state."""
        if node[0] == "set":
            end = self.state()
            self.steps[start].append((node[1], end))
            return end
        if node[0] == "seq":
            for part in node[1]:
                start = self.add(part, start)
            return start
        if node[0] == "alt":
            end = self.state()
            for part in node[1]:
                branch = self.state()
                self.free[start].append(branch)
                self.free[self.add(part, branch)].append(end)
            return end
        _, part, least, most = node
        for _ in range(least):
            start = self.add(part, start)
        if most is None:
            loop = self.state()
            self.free[start].append(loop)
            self.free[self.add(part, loop)].append(loop)
            return loop
        end = self.state()
        self.free[start].append(end)
        for _ in range(most - least):
            start = self.add(part, start)
            self.free[start].append(end)
        return end

    def closure(self, states) -> frozenset:
        seen, todo = set(states), list(states)
        while todo:
            for s in self.free[todo.pop()]:
                if s not in seen:
                    seen.add(s)
                    todo.append(s)
        return frozenset(seen)


@dataclass
class Automaton:
    """Transition arrays: ``table[state][byte]``, the rules (a bit mask) that
    end in each state, and the dead state, if there is one."""

    table: list[list[int]]
    masks: list[int]
    dead: int | None


def compiled(patterns: list, anywhere: bool) -> Automaton:
    """The minimal automaton of all patterns (parsed), from state 0;
    ``anywhere``: a match may start at any byte."""
    nfa = _Nfa()
    root = nfa.state()
    ends = []
    for node in patterns:
        start = nfa.state()
        nfa.free[root].append(start)
        ends.append(nfa.add(node, start))
    sets = {s for steps in nfa.steps for s, _ in steps}
    classes: dict[tuple, list[int]] = {}
    for b in range(256):
        classes.setdefault(tuple(b in s for s in sets), []).append(b)
    members = list(classes.values())
    first = nfa.closure([root])
    numbers, queue, table = {first: 0}, [first], []
    for states in queue:
        row = []
        for group in members:
            reached = {t for s in states for chars, t in nfa.steps[s] if group[0] in chars}
            following = nfa.closure(reached | ({root} if anywhere else set()))
            if following not in numbers:
                numbers[following] = len(queue)
                queue.append(following)
            row.append(numbers[following])
        table.append(row)
    masks = [sum(1 << k for k, end in enumerate(ends) if end in states) for states in queue]
    # Minimisation: states stay together while their successors do.
    block = masks
    while True:
        names: dict[tuple, int] = {}
        refined = [names.setdefault((block[s], *(block[t] for t in table[s])), len(names)) for s in range(len(table))]
        if len(names) == len(set(block)):
            break
        block = refined
    out_table: list = [None] * len(names)
    out_masks = [0] * len(names)
    for s, k in enumerate(refined):
        if out_table[k] is None:
            wide = [0] * 256
            for group, t in zip(members, table[s], strict=True):
                for b in group:
                    wide[b] = refined[t]
            out_table[k], out_masks[k] = wide, masks[s]
    dead = next((k for k, row in enumerate(out_table) if not out_masks[k] and set(row) == {k}), None)
    return Automaton(out_table, out_masks, dead)


# --- scanning -----------------------------------------------------------


def _linked(automaton: Automaton) -> tuple[list[list], dict[int, int]]:
    """Rows that refer to their successor rows, so a step is one look-up, and
    the rules that end in a row, by the row's identity."""
    rows: list[list] = [[] for _ in automaton.table]
    for row, successors in zip(rows, automaton.table, strict=True):
        row.extend(rows[t] for t in successors)
    return rows, {id(row): mask for row, mask in zip(rows, automaton.masks, strict=True) if mask}


def _longest(automaton: Automaton, data: bytes, at: int) -> int | None:
    """End of the longest match that starts at ``at``."""
    state, best, table, masks, dead = 0, None, automaton.table, automaton.masks, automaton.dead
    for at in range(at, len(data)):
        state = table[state][data[at]]
        if state == dead:
            break
        if masks[state]:
            best = at + 1
    return best


@dataclass
class BaseRules:
    """Automata of the base rules: all reversed, matching anywhere; one forward
    each; and of what comes before a counted group."""

    kinds: list[str]
    starts: Automaton
    forward: list[Automaton]
    heads: list[Automaton | None]
    least: list[int]


class Scanner:
    """Finds the rules' spans in the bytes of a text."""

    def __init__(self, rules: dict[str, tuple[str, int]], automaton: Automaton, backward: list[Automaton], base: BaseRules):
        self.kinds, self.least, self.backward, self.base = list(rules), [n for _, n in rules.values()], backward, base
        self.rows, self.mask_of = _linked(automaton)
        self.start_rows, self.start_mask_of = _linked(base.starts)

    def starts(self, data: bytes) -> list[list[int]]:
        """Per base rule: the places where a match starts, in order."""
        starting = self.start_mask_of
        found: list[list[int]] = [[] for _ in self.base.kinds]
        for n, row in enumerate(map(id, accumulate(reversed(data), getitem, initial=self.start_rows[0]))):
            if row in starting:
                mask = starting[row]
                for k, mine in enumerate(found):
                    if mask >> k & 1:
                        mine.append(len(data) - n)
        return [mine[::-1] for mine in found]

    def base_spans(self, rule: int, data: bytes, starts: list[int]) -> Iterator[tuple[int, int]]:
        """Leftmost, non-overlapping matches of a base rule that are long enough."""
        base, floor = self.base, 0
        for start in starts:
            if start < floor:
                continue
            end = _longest(base.forward[rule], data, start)
            counted = start if base.heads[rule] is None else _longest(base.heads[rule], data, start)
            if end - counted >= base.least[rule]:
                yield start, end
            floor = end

    def ends(self, data: bytes) -> dict[int, list[int]]:
        """Per rule: ends of its matches, one for each unbroken row of ends."""
        ending = self.mask_of
        found: dict[int, list[int]] = {}
        for at, row in enumerate(map(id, accumulate(data, getitem, initial=self.rows[0]))):
            if row in ending:
                mask, rule = ending[row], 0
                while mask:
                    if mask & 1:
                        mine = found.setdefault(rule, [])
                        if mine and mine[-1] == at - 1:
                            mine[-1] = at
                        else:
                            mine.append(at)
                    mask >>= 1
                    rule += 1
        return found

    def start(self, rule: int, data: bytes, end: int, floor: int) -> int | None:
        """The leftmost start, from ``floor`` on, of a match that ends at ``end``."""
        back, state, best, at = self.backward[rule], 0, None, end
        while at > floor and state != back.dead:
            at -= 1
            state = back.table[state][data[at]]
            if back.masks[state]:
                best = at
        return best

    def spans(self, text: str | None) -> tuple[list[tuple], list[tuple]]:
        """(base spans, all spans), each (start, kind number, end) in code
        points, by start, then kind, then end."""
        data = (text or "").encode("utf-8", "replace")
        ends = self.ends(data)
        if not ends:
            return [], []
        base, added = set(), set()
        met = [k for k, kind in enumerate(self.base.kinds) if kind in self.kinds and self.kinds.index(kind) in ends]
        starts = self.starts(data) if met else []
        for k in met:
            base.update((a, self.kinds.index(self.base.kinds[k]), b) for a, b in self.base_spans(k, data, starts[k]))
        for rule, places in ends.items():
            floor = 0
            for end in places:
                start = self.start(rule, data, end, floor)
                if start is not None and end - start >= self.least[rule]:
                    added.add((start, rule, end))
                    floor = end
        points = {}
        at = count = 0
        for place in sorted({p for a, _, b in base | added for p in (a, b)}):
            count += len(data[at:place].decode("utf-8", "replace"))
            points[place] = count
            at = place
        return tuple(sorted((points[a], k, points[b]) for a, k, b in spans) for spans in (base, base | added))


def build(rules: dict[str, tuple[str, int]] = RULES) -> tuple[dict, Automaton, list[Automaton], BaseRules]:
    parsed = [_Parser(p).parse() for p, _ in rules.values()]
    plain = [_Parser(p).parse() for p, _, _ in BASE_RULES.values()]
    base = BaseRules(list(BASE_RULES), compiled([_reversed(x) for x in plain], True), [compiled([x], False) for x in plain],
                     [compiled([_Parser(HEADS[k]).parse()], False) if k in HEADS else None for k in BASE_RULES],
                     [least for _, _, least in BASE_RULES.values()])
    return rules, compiled(parsed, True), [compiled([_reversed(x)], False) for x in parsed], base


def scan(docs: DataFrame, rules: dict[str, tuple[str, int]] = RULES) -> DataFrame:
    """doc_id, base and spans: arrays of (kind, start, end) of every row."""
    spark = docs.sparkSession
    workers_ready(spark)
    held = spark.sparkContext.broadcast(build(rules))
    kinds = list(rules)
    struct = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches):
        scanner = Scanner(*held.value)
        named = lambda spans: [{"kind": kinds[k], "start": a, "end": b} for a, k, b in spans]
        for batch in batches:
            found = [scanner.spans(t) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([
                batch.column("doc_id"), *(pa.array([named(x[i]) for x in found], pa.list_(struct)) for i in (0, 1))],
                names=["doc_id", "base", "spans"])

    spans = "array<struct<kind:string,start:bigint,end:bigint>>"
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, base {spans}, spans {spans}")


def digest(scanned: DataFrame) -> DataFrame:
    """Counts and digests of ``scan``: one row per document row."""
    joined = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    return scanned.select("doc_id", *(count(k) for k in BASE_RULES),
                          F.sha2(joined("base").cast("binary"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def base_digest(spans: list[tuple[str, int, int]]) -> str:
    """The digest of spans, for tests."""
    return hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
