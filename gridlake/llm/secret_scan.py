"""Secrets in texts: patterns, and automata learned from the credentials that the patterns find.

Patterns find assignments, access keys and long hexadecimal strings; their spans always stand.  The values found in the
corpus, and the same values in other known forms, are labelled credentials.  They are put into a tree of prefixes by kind;
states whose frequencies of going on and of ending do not differ more than chance allows are merged, from the root on,
into a probabilistic automaton.  Ordinary runs of the same characters give one more.  Every run of `SHORTEST` characters
or more apart from the pattern spans is scored by all automata, and added if one kind makes it `ODDS` times likelier
than ordinary runs do, and not less likely than nearly all its own credentials.

Edge cases: a null text is empty and has no spans; very long texts are searched whole; equal texts get equal spans;
repeated rows are searched as often as they occur; an empty table gives no rows; a kind without `FEWEST` distinct
credentials has no automaton and adds nothing; all columns are kept, and a clashing name is replaced.
"""

import base64
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gridlake.llm.common import read_table, small_batches

KINDS = ("assign", "access", "hex")
#: Distinct credentials of a kind, and four times as many ordinary runs, that automata are learned from at most; longer
#: ones than `LONGEST` characters are left out, so the sample has some 400 kB at most.
SAMPLE, LONGEST, FEWEST = 400, 128, 20
#: Characters of a candidate at least; share of chance at which states are held to differ; odds that add a span.
SHORTEST, ALPHA, ODDS = 16, 0.05, 1e5
#: Weight of the even spread over printable characters in every state.
SMOOTH, SYMBOLS = 0.05, 95

# --- patterns (fixed values) -------------------------------------------------------------------------

_KEYWORD = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
_VALUE = "([A-Za-z0-9+/_.=-]+)"
_ASSIGN = re.compile(_KEYWORD + _VALUE, re.I | re.A)
_ACCESS = re.compile("AKIA[A-Z0-9]{16,}")
_HEX = re.compile("[0-9a-f]{24,}")
SHORTEST_VALUE = 6


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end, by kind."""
    spans = [("assign", m.start(), m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= SHORTEST_VALUE]
    spans += [("access", m.start(), m.end()) for m in _ACCESS.finditer(text)]
    return spans + [("hex", m.start(), m.end()) for m in _HEX.finditer(text)]


# --- automata ----------------------------------------------------------------------------------------

class _Tree:
    """Prefixes of the strings: how often each is reached and is an end, and what follows it."""

    def __init__(self, strings: list[str]):
        self.reached, self.ends, self.after = [0], [0], [{}]
        for string in strings:
            at = 0
            self.reached[0] += 1
            for c in string:
                if c not in self.after[at]:
                    self.after[at][c] = len(self.reached)
                    self.reached.append(0)
                    self.ends.append(0)
                    self.after.append({})
                at = self.after[at][c]
                self.reached[at] += 1
            self.ends[at] += 1

    def alike(self, a: int, b: int, width: float) -> bool:
        """Whether two states, and all that both reach, go on and end alike, by Hoeffding's bound."""
        waiting = [(a, b)]
        while waiting:
            a, b = waiting.pop()
            m, n = self.reached[a], self.reached[b]
            bound = width * (1 / math.sqrt(m) + 1 / math.sqrt(n))
            if bound >= 1:
                continue  # no frequencies can differ by more
            if abs(self.ends[a] / m - self.ends[b] / n) > bound:
                return False
            for c in self.after[a].keys() | self.after[b].keys():
                x, y = self.after[a].get(c), self.after[b].get(c)
                if abs((self.passed(a, c) / m) - (self.passed(b, c) / n)) > bound:
                    return False
                if x is not None and y is not None and x != y:
                    waiting.append((x, y))
        return True

    def passed(self, a: int, c: str) -> int:
        return self.through.get((a, c), 0)

    def merge(self, alpha: float) -> list[int]:
        """Merge states that are alike; the states left."""
        width = math.sqrt(0.5 * math.log(2 / alpha))
        self.through = {(a, c): self.reached[b] for a, kids in enumerate(self.after) for c, b in kids.items()}
        kept, fringe = [0], sorted((c, 0) for c in self.after[0])
        while fringe:
            # The most frequent state first: it says most about what it is like.
            best = max(range(len(fringe)), key=lambda i: self.through[fringe[i][1], fringe[i][0]])
            c, parent = fringe.pop(best)
            state = self.after[parent][c]
            if state in kept:
                continue
            target = next((k for k in kept if self.alike(k, state, width)), None)
            if target is None:
                kept.append(state)
            else:
                self.after[parent][c] = target
                self._fold(target, state)
            known = set(kept)
            fringe = sorted((c, k) for k in kept for c, b in self.after[k].items() if b not in known)
        return kept

    def _fold(self, target: int, state: int) -> None:
        """Add a tree state and what follows it to `target`."""
        waiting = [(target, state)]
        while waiting:
            target, state = waiting.pop()
            self.reached[target] += self.reached[state]
            self.ends[target] += self.ends[state]
            for c, b in self.after[state].items():
                self.through[target, c] = self.passed(target, c) + self.passed(state, c)
                if c in self.after[target]:
                    waiting.append((self.after[target][c], b))
                else:
                    self.after[target][c] = b


@dataclass(frozen=True)
class Automaton:
    """By state: what each known character leads to and its log chance, the log chance of others and of ending.

    `usual` has the state that a character leads to most often, which is where it leads from a state that never saw it.
    """

    steps: list[dict[str, tuple[int, float]]]
    other: list[float]
    end: list[float]
    usual: dict[str, int]

    def score(self, string: str) -> float:
        at, total = 0, 0.0
        for c in string:
            step = self.steps[at].get(c)
            if step is None:
                total += self.other[at]
                at = self.usual.get(c, at)
            else:
                at, chance = step
                total += chance
        return total + self.end[at]


def learn(strings: list[str], alpha: float = ALPHA) -> Automaton:
    tree = _Tree(sorted(strings))
    kept = tree.merge(alpha)
    place = {state: i for i, state in enumerate(kept)}
    steps, other, end, led = [], [], [], {}
    for state in kept:
        # Folding may give a state more passages than it was reached by tree paths; their sum is what counts.
        passed = {c: tree.passed(state, c) for c in tree.after[state]}
        total = sum(passed.values()) + tree.ends[state] + SMOOTH * (SYMBOLS + 1)
        steps.append({c: (place[b], math.log((passed[c] + SMOOTH) / total)) for c, b in tree.after[state].items()})
        for c, n in passed.items():
            to = place[tree.after[state][c]]
            led[c, to] = led.get((c, to), 0) + n
        other.append(math.log(SMOOTH / total))
        end.append(math.log((tree.ends[state] + SMOOTH) / total))
    usual = {c: to for (c, to), _ in sorted(led.items(), key=lambda x: (x[1], x[0]))}
    return Automaton(steps, other, end, usual)


@dataclass(frozen=True)
class Formats:
    """Automata by kind with the log chance per character that nearly all credentials of the kind reach."""

    kinds: dict[str, tuple[Automaton, float]]
    ordinary: Automaton

    def kind_of(self, run: str) -> tuple[str, float] | None:
        """The likeliest kind of a run and the log of its odds, if it is likely enough."""
        best = None
        for kind, (automaton, least) in self.kinds.items():
            score = automaton.score(run)
            odds = score - self.ordinary.score(run)
            if odds >= math.log(ODDS) and score / len(run) >= least and (best is None or odds > best[1]):
                best = kind, odds
        return best


def other_forms(kind: str, value: str) -> list[str]:
    """The same credential as other programs print it."""
    if re.fullmatch("([0-9a-f]{2})+", value):
        data = bytes.fromhex(value)
        pairs = [value[i:i + 2] for i in range(0, len(value), 2)]
        return [value.upper(), ":".join(pairs), ":".join(pairs).upper(), base64.b64encode(data).decode(),
                base64.urlsafe_b64encode(data).decode().rstrip("=")]
    return ["ASIA" + value[4:]] if kind == "access" else []


def look_alikes(value: str) -> list[str]:
    """Runs that share characters with a credential and are none: numbers of card and of time-stamp length."""
    number = str(int.from_bytes(value.encode(), "big"))
    return [number[-16:], number[-20:]]


def train(credentials: dict[str, list[str]], ordinary: list[str]) -> Formats:
    kinds = {}
    for kind in KINDS:
        values = sorted(v for v in set(credentials.get(kind, [])) if len(v) >= SHORTEST)
        if len(values) < FEWEST:
            continue
        forms = [f for v in values for f in [v, *other_forms(kind, v)]]
        automaton = learn(forms)
        scores = sorted(automaton.score(f) / len(f) for f in forms)
        kinds[kind] = automaton, scores[len(scores) // 100]
    numbers = [n for kind in kinds for v in sorted(set(credentials[kind])) for n in look_alikes(v)]
    return Formats(kinds, learn(ordinary + [o.upper() for o in ordinary] + numbers))


# --- candidates --------------------------------------------------------------------------------------

_RUN = "[A-Za-z0-9+/_=.:-]"
_CANDIDATE = re.compile(f"{_RUN}{{{SHORTEST},}}")
_ENDS = ".:-"


def candidates(text: str) -> Iterator[tuple[int, int]]:
    """Start and end of runs that may be credentials, without the marks of a sentence around them."""
    for m in _CANDIDATE.finditer(text):
        run = m[0].rstrip(_ENDS)
        start = m.end() - len(m[0].lstrip(_ENDS))
        end = m.start() + len(run)
        if end - start >= SHORTEST:
            yield start, end


def all_spans(formats: Formats | None, text: str | None) -> list[tuple[str, int, int, bool]]:
    """Kind, start, end and whether a pattern found it, by start and kind."""
    if not text:
        return []
    base = pattern_spans(text)
    spans = [(*s, True) for s in base]
    if formats and formats.kinds:
        taken, at = sorted((s, e) for _, s, e in base), 0
        for start, end in candidates(text):
            while at < len(taken) and taken[at][1] <= start:
                at += 1
            if any(s < end and e > start for s, e in taken[at:at + len(KINDS) + 1]):
                continue
            found = formats.kind_of(text[start:end])
            if found:
                spans.append((found[0], start, end, False))
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


# --- on tables ---------------------------------------------------------------------------------------

def _sample(values: DataFrame, size: int) -> list[str]:
    """The distinct values of the smallest hashes; tasks send `size` short strings each."""
    rows = values.where(F.length("value").between(SHORTEST, LONGEST)).select("value").distinct()
    return [r.value for r in rows.orderBy(F.xxhash64("value"), "value").limit(size).collect()]


def fit_formats(docs: DataFrame, sample: int = SAMPLE) -> Formats:
    """Automata from what the patterns find in all texts, `sample` credentials of a kind at most.

    Ordinary runs are those without a credential in them, also in capitals; numbers made of credentials are added to them.
    """
    text = F.coalesce("text", F.lit(""))
    found = {
        "assign": F.regexp_extract_all(text, F.lit(f"(?i){_KEYWORD}{_VALUE}"), F.lit(2)),
        "access": F.regexp_extract_all(text, F.lit(f"({_ACCESS.pattern})"), F.lit(1)),
        "hex": F.regexp_extract_all(text, F.lit(f"({_HEX.pattern})"), F.lit(1)),
    }
    credentials = {kind: _sample(docs.select(F.explode(values).alias("value")), sample) for kind, values in found.items()}
    if not any(len(v) >= FEWEST for v in credentials.values()):
        return Formats({}, learn([]))
    runs = F.regexp_extract_all(text, F.lit(f"({_CANDIDATE.pattern})"), F.lit(1))
    ordinary = docs.select(F.explode(runs).alias("value")).where(
        ~F.rlike("value", F.lit(f"{_HEX.pattern}|{_ACCESS.pattern}")))
    known = {v for values in credentials.values() for v in values}
    return train(credentials, [v for v in _sample(ordinary, 4 * sample) if v not in known])


SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def with_secrets(docs: DataFrame, formats: Formats | None, name: str = "spans") -> DataFrame:
    """The documents with all spans of secrets."""
    small_batches(docs.sparkSession)

    @F.pandas_udf(SPANS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([
                [{"kind": k, "start": s, "end": e, "base": b} for k, s, e, b in all_spans(formats, t)]
                for t in batch], dtype=object)

    return docs.withColumn(name, find(F.col("text")))


def written(spans) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op12_secret_scan(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_secrets(docs, fit_formats(docs))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(written(base), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))
