"""Personal data: patterns, and a semi-Markov conditional random field for what they miss.

Patterns find emails, addresses, cards and phones; their spans always stand.  The field works on stretches of text with
digits, at-signs or bracketed `at` and `dot`.  A stretch is cut into tokens, every run of at most `LONGEST` tokens (with
an at, `LONGEST_AT`) is a candidate segment, whole-segment features (make-up, counts, check sums, outer words) score it for each kind, and dynamic
programming picks the best split into segments and kinds at once.  Weights maximise the likelihood of the
patterns' own spans in a bounded sample, which is enlarged by the same data in forms that the patterns do not know.  Only
segments apart from all pattern spans are added.

Edge cases: a null text is empty and has no spans; very long texts are searched whole, in time proportional to their
length; equal texts get equal spans; repeated rows are searched as often as they occur; an empty table gives no rows;
without any pattern span in the sample nothing is added; all columns are kept, and a clashing name is replaced.
"""

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from gridlake.llm.common import read_table, small_batches
from gridlake.llm.fitting import bounded, fit_in_task

KINDS = ("email", "ip", "card", "phone")
#: Documents with pattern spans that the field is fitted on at most, and as many without.
SAMPLE = 250
#: Tokens of a segment at most, and of one with an at, which can only be an email.
LONGEST, LONGEST_AT, WORD_CHARS = 16, 32, 40
ROUNDS, RATE, SEED = 4, 0.3, 5

# --- patterns ----------------------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never begins inside a run of digits, so the runs' insides need not be tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = sum(int(d) if i % 2 == 0 else (0, 2, 4, 6, 8, 1, 3, 5, 7, 9)[int(d)] for i, d in enumerate(digits[::-1]))
    return total % 10 == 0


def emails(text: str) -> list[tuple[int, int]]:
    out, done, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        tail = _DOMAIN.match(text, at + 1) if start < at else None
        if tail:
            done = tail.end()
            out.append((start, done))
        at = text.find("@", at + 1)
    return out


def pattern_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end, by kind and start."""
    spans = [("email", s, e) for s, e in emails(text)]
    spans += [("ip", m.start(), m.end()) for m in _IP.finditer(text)
              if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    for m in _CARD.finditer(text):
        digits = _NO_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(("card", m.start(), m.end()))
    if "+" in text:
        spans += [("phone", m.start(), m.end()) for m in _PHONE.finditer(text)
                  if 8 <= len(_NO_DIGIT.sub("", m[0])) <= 15]
    return spans


# --- candidates --------------------------------------------------------------------------------------

_NEAR = r"\S*[0-9@]\S*"
_STRETCH = re.compile(rf"(?:\S+ ?[\[(] ?at ?[\])] ?\S+(?: ?[\[(] ?dot ?[\])] ?\S+)*)|(?:\(?{_NEAR}(?: {_NEAR})*)")
_QUICK = re.compile(r"[0-9@]|[\[(] ?at ?[\])]")
_TOKEN = re.compile(r" ?[\[(] ?(?:at|dot) ?[\])] ?|[A-Za-z]+|[0-9]+|[^\W\d_]+|\s+|.", re.S)
_BEFORE = re.compile(r"([^\W\d_]+)[\s:=]*$")


def stretches(text: str) -> Iterator[tuple[int, str]]:
    """Start and text of what may hold personal data; lines are searched one by one, only those with a trace of it."""
    at = 0
    for line in text.split("\n"):
        if _QUICK.search(line):
            for m in _STRETCH.finditer(line):
                yield at + m.start(), m[0]
        at += len(line) + 1


def tokens(text: str) -> list[tuple[int, int, str]]:
    return [(m.start(), m.end(), m[0]) for m in _TOKEN.finditer(text)]


def make_up(token: str) -> str:
    """Digits by their number, letters by script, `at` and `dot` with or without brackets, blanks as one, others as they are."""
    word = token.strip(" []()")
    if word in ("at", "dot"):
        return word
    if token.isdigit():
        return f"0{min(len(token), 9)}"
    if token.isalpha():
        return "a" if token.isascii() else "l"
    return " " if token.isspace() else token[0]


def features(parts: list[tuple[int, int, str]], i: int, j: int, before: str) -> list[str]:
    """Whole-segment features of tokens i to j (j excluded)."""
    words = [t for _, _, t in parts[i:j]]
    shapes = [make_up(t) for t in words]
    text = "".join(words)
    digits = "".join(t for t in words if t.isdigit() and t.isascii())
    out = [f"first {shapes[0]}", f"last {shapes[-1]}", f"length {j - i}", f"digits {min(len(digits), 20)}",
           f"at {text.count('@') + shapes.count('at')}", f"dots {min(text.count('.') + shapes.count('dot'), 5)}",
           f"letters {sum(s in ('a', 'l') for s in shapes) > 0}",
           f"marks {''.join(sorted({s for s in shapes if len(s) == 1 and not s.isalnum()}))[:6]}"]
    if j - i <= 8:
        out.append("shape " + "".join(shapes))
    if len(digits) >= 12:
        out.append(f"sum {16 <= len(digits) <= 19 and luhn(digits)}")
    octets = text.split(".")
    if len(octets) == 4:
        out.append(f"octets {all(o.isdigit() and len(o) <= 3 and int(o) <= 255 for o in octets)}")
    out.append(f"left {make_up(parts[i - 1][2]) if i else 'edge'}")
    out.append(f"right {make_up(parts[j][2]) if j < len(parts) else 'edge'}")
    if i == 0 and before:
        out.append(f"before {before[:12].lower()}")
    return out


# --- the field ---------------------------------------------------------------------------------------

@dataclass
class Field:
    """Weights by feature (a row per kind, the last for none), and by pairs of kinds that follow each other."""

    weights: dict[str, np.ndarray]
    follow: np.ndarray

    def segments(self, parts, before) -> list[tuple[int, int, list[str]]]:
        return [s for j in range(1, len(parts) + 1) for s in self.segments_to(parts, j, before)]

    def segments_to(self, parts, j, before) -> list[tuple[int, int, list[str]]]:
        """The segments whose last token is the one before `j`."""
        low, short = max(0, j - LONGEST_AT), max(0, j - LONGEST)
        at = max((i for i in range(low, j) if make_up(parts[i][2]) in ("@", "at")), default=-1)
        begins = [*range(low, min(short, at + 1)), *range(short, j)]
        return [(i, j, features(parts, i, j, before)) for i in begins]

    def scores(self, found) -> np.ndarray:
        """A row per segment; only single tokens may be of no kind, blanks neither begin nor end a segment of one."""
        out = np.zeros((len(found), len(KINDS) + 1))
        for row, (i, j, names) in zip(out, found):
            for name in names:
                w = self.weights.get(name)
                if w is not None:
                    row += w
            if j - i > 1:
                row[-1] = -np.inf
            if j - i > LONGEST:
                row[KINDS.index("email") + 1:] = -np.inf
        return out

    def best(self, parts, before) -> list[tuple[str, int, int]]:
        """Kinds with first and last token of the most likely split; features are kept for one last token at a time."""
        n, k = len(parts), len(KINDS) + 1
        top = np.full((n + 1, k), -np.inf)
        top[0, -1] = 0
        begin, source = np.zeros((n + 1, k), np.int64), np.zeros((n + 1, k), np.int8)
        for j in range(1, n + 1):
            found = self.segments_to(parts, j, before)
            ways = top[[i for i, _, _ in found]][:, :, None] + self.follow
            value = ways.max(axis=1) + self.scores(found)
            pick = value.argmax(axis=0)
            top[j] = value[pick, range(k)]
            begin[j] = [found[x][0] for x in pick]
            source[j] = ways.argmax(axis=1)[pick, range(k)]
        out, at, kind = [], n, int(top[n].argmax())
        while at:
            start = int(begin[at, kind])
            if kind < len(KINDS):
                out.append((KINDS[kind], start, at))
            at, kind = start, int(source[at, kind])
        return out[::-1]

    def learn(self, parts, before, gold: dict[tuple[int, int], int], rate: float) -> None:
        """A step along the gradient of the log-likelihood of a split, by forward and backward sums over segments."""
        found = self.segments(parts, before)
        scores, n, k = self.scores(found), len(parts), len(KINDS) + 1
        ahead, behind = np.full((n + 1, k), -np.inf), np.full((n + 1, k), -np.inf)
        ahead[0, -1] = 0
        behind[n] = 0
        into = np.full((len(found), k), -np.inf)
        with np.errstate(divide="ignore"):
            for x, (i, j, _) in enumerate(found):
                into[x] = np.logaddexp.reduce(ahead[i][:, None] + self.follow, axis=0)
                ahead[j] = np.logaddexp(ahead[j], into[x] + scores[x])
            for x in sorted(range(len(found)), key=lambda x: -found[x][0]):
                i, j, _ = found[x]
                behind[i] = np.logaddexp(behind[i], np.logaddexp.reduce(
                    self.follow + (scores[x] + behind[j])[None, :], axis=1))
        total = np.logaddexp.reduce(ahead[n])
        slope_follow, last = np.zeros_like(self.follow), len(KINDS)
        for x, (i, j, names) in enumerate(found):
            chance = np.exp(into[x] + scores[x] + behind[j] - total)
            slope = -chance
            if (i, j) in gold:
                slope[gold[i, j]] += 1
            if np.abs(slope).max() > 1e-4:
                for name in names:
                    self.weights.setdefault(name, np.zeros(k))
                    self.weights[name] += rate * slope
            pair = np.exp(ahead[i][:, None] + self.follow + (scores[x] + behind[j])[None, :] - total)
            slope_follow -= pair
        for (i, j), kind in sorted(gold.items()):
            slope_follow[last, kind] += 1
            last = kind
        self.follow += rate * 0.1 * slope_follow


# --- fitting -----------------------------------------------------------------------------------------

def other_forms(kind: str, text: str) -> list[str]:
    """The same data as people write it to evade patterns, or in national styles."""
    if kind == "email":
        name, _, host = text.partition("@")
        return [f"{name} [at] {host.replace('.', ' [dot] ')}", f"{name}(at){host.replace('.', '(dot)')}",
                f"{name} (at) {host}", f"{name} @ {host}"]
    digits = _NO_DIGIT.sub("", text)
    if kind == "card":
        return [".".join(digits[i:i + 4] for i in range(0, len(digits), 4)),
                "/".join(digits[i:i + 4] for i in range(0, len(digits), 4))]
    if kind == "phone":
        local = digits[-10:]
        return [f"({local[:3]}) {local[3:6]}-{local[6:]}", f"00{digits}", f"{local[:3]}-{local[3:6]}-{local[6:]}"]
    return [text.replace(".", "[.]"), text.replace(".", " . ")]


def look_alikes(kind: str, text: str) -> list[str]:
    """What shares characters with personal data and is none: dates, decimals, versions, failed check sums."""
    digits = _NO_DIGIT.sub("", text)
    if kind == "card":
        wrong = digits[:-1] + str((int(digits[-1]) + 1) % 10)
        return [wrong, " ".join(wrong[i:i + 4] for i in range(0, len(wrong), 4)), digits[:6]]
    if kind == "phone":
        return [f"20{digits[:2]}-{digits[2:4]}-{digits[4:6]}", f"{digits[:2]}/{digits[2:4]}/{digits[4:8]}", digits[:5]]
    if kind == "ip":
        first, second, third, _ = text.split(".")
        return [f"{first}.{second}", f"{first}.{second}.{third}", f"{first},{second}"]
    return ["@" + text.partition("@")[0], text.partition("@")[2] + "1"]


def examples(texts: list[str]) -> list[tuple[list, str, dict[tuple[int, int], int]]]:
    """Tokens, the word before and the true split of every stretch, and of its other forms."""
    out = []
    for text in texts:
        spans = pattern_spans(text)
        for start, stretch in stretches(text):
            end = start + len(stretch)
            own = sorted((s - start, e - start, k) for k, s, e in spans if s >= start and e <= end)
            before = _BEFORE.search(text, max(0, start - WORD_CHARS), start)
            variants = [(stretch, own)]
            if len(own) == 1:
                s, e, kind = own[0]
                variants += [(stretch[:s] + form + stretch[e:], [(s, s + len(form), kind)])
                             for form in other_forms(kind, stretch[s:e])]
                variants += [(stretch[:s] + form + stretch[e:], []) for form in look_alikes(kind, stretch[s:e])]
            for form, marked in variants:
                parts = tokens(form)
                starts, ends = {p[0]: n for n, p in enumerate(parts)}, {p[1]: n + 1 for n, p in enumerate(parts)}
                gold, covered, whole = {}, set(), True
                for s, e, kind in marked:
                    longest = LONGEST_AT if kind == "email" else LONGEST
                    if not (s in starts and e in ends and 0 < ends[e] - starts[s] <= longest):
                        whole = False  # no segment can be this span, and its tokens are not of no kind
                    else:
                        inside = set(range(starts[s], ends[e]))
                        if not inside & covered:
                            gold[starts[s], ends[e]] = KINDS.index(kind)
                            covered |= inside
                gold |= {(n, n + 1): len(KINDS) for n in range(len(parts)) if n not in covered}
                if whole and len(parts) <= 60:
                    out.append((parts, before[1] if before else "", gold))
    return out


def train(texts: list[str]) -> Field | None:
    """A field from texts; None if the patterns find nothing in them."""
    known = examples(texts)
    if not any(kind < len(KINDS) for _, _, gold in known for kind in gold.values()):
        return None
    rng = np.random.default_rng(SEED)
    if len(known) > 6 * SAMPLE:
        known = [known[i] for i in rng.permutation(len(known))[:6 * SAMPLE]]
    field = Field({}, np.zeros((len(KINDS) + 1, len(KINDS) + 1)))
    for turn in range(ROUNDS):
        for i in rng.permutation(len(known)):
            field.learn(*known[i], RATE / (1 + turn))
    return field


def all_spans(field: Field | None, text: str | None) -> list[tuple[str, int, int, bool]]:
    """Kind, start, end and whether a pattern found it, by kind and start."""
    if not text:
        return []
    base = pattern_spans(text)
    spans = [(*s, True) for s in base]
    if field:
        for start, stretch in stretches(text):
            end = start + len(stretch)
            taken = [(s, e) for _, s, e in base if s < end and e > start]
            if sum(e - s for s, e in taken) >= len(stretch.strip(".,;:!?()")):
                continue  # nothing left to find
            before = _BEFORE.search(text, max(0, start - WORD_CHARS), start)
            parts = tokens(stretch)
            for kind, i, j in field.best(parts, before[1] if before else ""):
                s, e = start + parts[i][0], start + parts[j - 1][1]
                if all(e <= x or s >= y for x, y in taken):
                    spans.append((kind, s, e, False))
    return sorted(spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


SPANS = "array<struct<kind:string,start:long,end:long,base:boolean>>"


def spans_column(field: Field | None, text: Column) -> Column:
    @F.pandas_udf(SPANS)
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([
                [{"kind": k, "start": s, "end": e, "base": b} for k, s, e, b in all_spans(field, t)]
                for t in batch], dtype=object)

    return find(text)


def redacted_column(field: Field | None, text: Column) -> Column:
    """The text with every span replaced by its kind in angle brackets; spans that overlap become one."""
    @F.pandas_udf("string")
    def redact(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        def one(value):
            parts, done = [], 0
            for kind, start, end, _ in sorted(all_spans(field, value), key=lambda s: (s[1], -s[2])):
                if start >= done:
                    parts += [value[done:start], f"<{kind.upper()}>"]
                done = max(done, end)
            return value if not parts else "".join(parts) + value[done:]

        for batch in batches:
            yield pd.Series([one(t) for t in batch], dtype=object)

    return redact(text)


def fit_pii(docs: DataFrame, sample: int = SAMPLE) -> Field | None:
    """A field fitted on the documents of the smallest hashes, half of them with an at-sign, plus or long number.

    `sample` texts and `MOST_CHARS` characters of either half at most; a longer text is never in the sample.
    """
    likely = F.rlike("text", F.lit(r"@[A-Za-z0-9-]+\.|\+[0-9]|[0-9]{12}|[0-9]\.[0-9]+\.[0-9]"))
    texts = docs.select(F.xxhash64("doc_id", "text").alias("place"), F.coalesce("text", F.lit("")).alias("text"))
    keys = texts.select("place", likely.alias("likely"), F.length("text").cast("long").alias("chars"))
    chosen = bounded(keys, "likely", [F.col("place")], sample).select("place").distinct()
    # At most 2 * sample hashes, and one text of each.
    rows = texts.join(F.broadcast(chosen), "place").groupBy("place").agg(F.first("text").alias("text")).select("text")
    return fit_in_task(rows, lambda found: train(sorted({text for text, in found})))


def with_spans(docs: DataFrame, field: Field | None, name: str = "spans") -> DataFrame:
    """The documents with all spans of personal data."""
    small_batches(docs.sparkSession)
    return docs.withColumn(name, spans_column(field, F.col("text")))


def written(spans) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def op6_pii(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = with_spans(docs, fit_pii(docs))
    base = F.filter("spans", lambda s: s["base"])

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, KINDS), F.sha2(written(base), 256).alias("base_sha256"),
                        written(F.col("spans")).alias("spans"))
