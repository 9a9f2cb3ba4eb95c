"""Patterns against their plain statement, automata against counted frequencies, and recall on forms never seen."""

import hashlib
import math
import os
import random
import re

import pytest

from gridlake.llm import secret_scan as secrets

SF_DIR = os.environ.get("GRIDLAKE_TEST_SF_DIR", "/root/testdata/sf0.001")
RULES = {
    "assign": (r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
               lambda m: len(m[2]) >= 6),
    "access": ("AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    "hex": ("[0-9a-f]+", lambda m: len(m[0]) >= 24),
}


def plain_spans(text):
    return [(k, m.start(), m.end()) for k, (rule, holds) in RULES.items()
            for m in re.finditer(rule, text or "", re.A) if holds(m)]


def digests(text):
    spans = sorted(plain_spans(text), key=lambda s: (s[1], list(RULES).index(s[0])))
    written = ",".join(f"{k}:{s}:{e}" for k, s, e in spans)
    counts = [sum(k == kind for k, _, _ in spans) for kind in RULES]
    return (*counts, hashlib.sha256(written.encode()).hexdigest()), written


def texts():
    rng = random.Random(12)
    hexes = ["".join(rng.choice("0123456789abcdef") for _ in range(rng.choice([23, 24, 32, 40]))) for _ in range(60)]
    keys = ["AKIA" + "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ234567") for _ in range(16)) for _ in range(60)]
    out = [None, "", " ", "secret: token: abcdefgh", "token = 'abc' token=abcdef", "TOKEN=toKen=toKen=a", "api_keyapikey:x_y.z=-",
           "ſecret=abcdefgh toKen=abcdefgh", "é" * 9 + "passwd\"  =  \"ünï", "AKIA" + "A" * 15, "AKIAAKIA" + "A" * 16,
           "f" * 24, "0" * 23 + "g" + "a" * 30, "password=\n123456", "x" * 200_000 + " secret=zzzzzz"]
    for a, b in zip(hexes, keys):
        out.append(f"some text {rng.choice(['token', 'Secret', 'apikey'])} = \"{a}\", key {b}. end of it")
    return out


def test_patterns():
    for text in texts():
        assert sorted(secrets.pattern_spans(text or "")) == sorted(plain_spans(text))


def test_frequencies_become_chances():
    """Strings of `a`s then `b`: two states, whose chances are the counted ones but for smoothing."""
    rng = random.Random(3)
    strings = ["a" * min(int(rng.expovariate(0.2)), 60) + "b" for _ in range(800)]
    automaton = secrets.learn(strings)
    assert len(automaton.steps) <= 3
    more = sum(len(s) - 1 for s in strings) / sum(len(s) for s in strings)
    for n in (0, 3, 9):
        assert math.exp(automaton.score("a" * n + "b")) == pytest.approx(more ** n * (1 - more), rel=0.25)
    for steps, other, end in zip(automaton.steps, automaton.other, automaton.end):
        rest = (secrets.SYMBOLS - len(steps)) * math.exp(other)
        assert sum(math.exp(p) for _, p in steps.values()) + rest + math.exp(end) == pytest.approx(1)


def test_states_that_differ_stay_apart():
    rng = random.Random(4)
    strings = ["".join(rng.choice("01") for _ in range(6)) + "x" + "".join(rng.choice("yz") for _ in range(6))
               for _ in range(600)]
    automaton = secrets.learn(strings)
    assert automaton.score("010101xyzyzyz") > automaton.score("yzyzyzx010101") + 20
    assert automaton.score("010101xyzyzyz") > automaton.score("0101010101010") + 5


@pytest.fixture(scope="module")
def formats(spark):
    docs = [(i, t) for i, t in enumerate(texts())]
    rng = random.Random(5)
    words = ["internationalisation", "https://example.org/a/page.html", "2024-01-31T10:20:30", "some.body@example.com",
             "counterrevolutionary", "path/to/some/file.txt", "4652511922028856", "key-value-pairs-in-text"]
    docs += [(1000 + i, " ".join(rng.choice(words) + rng.choice(["", "s", str(rng.randrange(99))]) for _ in range(20)))
             for i in range(60)]
    return secrets.fit_formats(spark.createDataFrame(docs, "doc_id long, text string"))


def test_forms_of_unseen_credentials_are_found(formats):
    rng = random.Random(99)
    right, wrong = 0, 0
    for _ in range(100):
        data = bytes(rng.randrange(256) for _ in range(20))
        key = "ASIA" + "".join(rng.choice("ABCDEFGHJKLMNPQRSTUVWXYZ234567") for _ in range(16))
        for run in (data.hex().upper(), ":".join(f"{b:02x}" for b in data), key):
            text = f"it is {run}, as said"
            right += [s[1:] for s in secrets.all_spans(formats, text)] == [(6, 6 + len(run), False)]
        for run in (str(rng.randrange(10 ** 15, 10 ** 16)), "internationalisations", "COUNTERREVOLUTIONARIES",
                    f"https://example.org/a/page{rng.randrange(99)}.html", f"2024-02-{rng.randrange(10, 28)}T11:21:31"):
            wrong += bool(secrets.all_spans(formats, f"it is {run}, as said"))
    assert right >= 285 and wrong == 0


def test_base_spans_stand_and_added_ones_are_apart(spark, formats):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts())] * 2, "doc_id long, text string, spans string")
    found = secrets.with_secrets(docs, formats).collect()
    assert len(found) == 2 * len(texts())
    for r in found:
        base = [(s.kind, s.start, s.end) for s in r.spans if s.base]
        assert sorted(base) == sorted(plain_spans(r.text))
        assert all(s.end <= b[1] or s.start >= b[2] for s in r.spans if not s.base for b in base)


def test_query(spark, tmp_path):
    found = secrets.op12_secret_scan(spark, SF_DIR)
    assert found.columns == ["doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans"]
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()}
    rows = found.collect()
    assert len(rows) == len(docs)
    for r in rows:
        base, written = digests(docs[r.doc_id])
        assert tuple(r)[1:5] == base
        assert set(written.split(",")) <= set(r.spans.split(","))
    for data in (texts()[:14], []):
        spark.createDataFrame([(i, t) for i, t in enumerate(data)], "doc_id long, text string").write.mode(
            "overwrite").parquet(str(tmp_path / "documents.parquet"))
        got = {r.doc_id: tuple(r)[1:5] for r in secrets.op12_secret_scan(spark, str(tmp_path)).collect()}
        assert got == {i: digests(t)[0] for i, t in enumerate(data)}
