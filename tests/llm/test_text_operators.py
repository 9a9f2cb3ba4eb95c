"""Operators that SQL cannot express, against brute force, exact round trips or held-out accuracy, and edge cases."""

import random
import re

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer, models

from gridlake.llm import decontamination as dec, pii, quality_classifier as qc, token_counts as tc, toxicity as tox
from gridlake.llm.labels import labelled_sample

COLUMNS = "doc_id long, text string, score string, hits string, spans string, n_tokens string"
ROWS = [(1, None), (2, ""), (3, "a b c"), (3, "a b c"), (None, "no id"), (4, "word " * 20_000), (5, "x" * 30_000)]


def odd(spark, rows=ROWS):
    """Nulls, empty and long texts, repeated rows, and columns with the names of results."""
    return spark.createDataFrame([(i, t, "s", "h", "p", "n") for i, t in rows], COLUMNS)


def test_token_counts_equal_a_unigram_model():
    scores = tc.piece_scores(public_tokenizers.path("piece_bpe_32k.model"))
    library = Tokenizer(models.Unigram([("<unk>", -100.0), *scores.items()], unk_id=0))
    rng, counter = random.Random(1), tc.TokenCounter(scores)
    words = ["".join(rng.choice("thereanonstiouabc") for _ in range(rng.randint(1, 14))) for _ in range(800)]
    for word in words:
        n = len(library.encode(tc.MARK + word).ids)
        assert counter.words([word]) == n and counter.alone(tc.MARK + word) == n
    assert counter.words(["日"]) >= 1 and counter.words([]) == 0


def test_token_counts_edge_cases(spark):
    out = tc.with_token_counts(odd(spark), public_tokenizers.path("piece_bpe_32k.model"))
    assert out.columns.count("n_tokens") == 1
    got = [(r.doc_id, r.n_pretokens) for r in out.collect()]
    assert sorted(got, key=str) == sorted([(1, 0), (2, 0), (3, 3), (3, 3), (None, 2), (4, 20_000), (5, 1)], key=str)


def closest(item, text):
    """Fewest edits between `item` and any stretch of `text`, cell by cell."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, d in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != d))
    return min(row)


def test_decontamination_against_brute_force():
    rng = random.Random(2)

    def words(n):
        return " ".join("".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(n))

    items = [(i, words(rng.randint(3, 20))) for i in range(12)] + [(90, ""), (91, "ab"), (92, None)]
    texts = []
    for _ in range(60):
        i, item = rng.choice(items[:12])
        noisy = list(item.upper() if rng.random() < 0.3 else item)
        for _ in range(rng.randint(0, 10)):
            at = rng.randrange(len(noisy))
            noisy[at] = rng.choice(["", "z", noisy[at] + "q"])
        texts.append(words(rng.randint(0, 30)) + "\n" + "".join(noisy) + " " + words(rng.randint(0, 9)))
    for text, hits in zip(texts, dec.Items(items).search(texts)):
        expected = {i for i, t in items if t and len(dec.plain(t)) >= dec.Q
                    and closest(dec.plain(t), dec.plain(text)) <= dec.budget(len(t))}
        assert {h[0] for h in hits} == expected
        for i, start, end, edits in hits:
            assert closest(dec.plain(dict(items)[i]), dec.plain(text)[start:end]) == edits


def test_decontamination_edge_cases(spark):
    items = spark.createDataFrame([(1, None), (2, ""), (3, "word word word word word")], "item_id long, text string")
    out = dec.with_hits(odd(spark), items)
    assert {r.doc_id for r in out.collect() if r.hits} == {4} and out.count() == len(ROWS)
    assert all(not r.hits for r in dec.with_hits(odd(spark), items.limit(0)).collect())


BASE = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
        "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
        "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def plain_spans(text):
    out = []
    for kind, pattern in BASE.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if not (kind == "ip" and any(int(p) > 255 for p in m[0].split("."))
                    or kind == "card" and not (16 <= len(digits) <= 19 and pii.luhn(digits))
                    or kind == "phone" and not 8 <= len(digits) <= 15):
                out.append((kind, m.start(), m.end()))
    return out


def test_patterns_against_plain_regular_expressions():
    rng = random.Random(3)
    for _ in range(4000):
        text = "".join(rng.choice("01234 56789..@@+-()ab \n%_é") for _ in range(80))
        assert pii.pattern_spans(text) == plain_spans(text)


def test_field_adds_and_keeps(spark):
    texts = [f"call +1 (255) 555-8{i:03} or mail ann{i}@mail.example.com from 10.0.{i}.7 now" for i in range(60)]
    field = pii.train(texts + ["the 12 of 2024-01-02 was 10.30 warm"] * 5)
    found = pii.all_spans(field, "ring (255) 555-8013 now")
    assert [(k, b) for k, _, _, b in found] == [("phone", False)]
    assert pii.all_spans(field, "it was 10.30 warm") == [] and pii.train(["nothing here"]) is None
    for text in texts[:5]:
        assert [s[:3] for s in pii.all_spans(field, text) if s[3]] == plain_spans(text)
    out = pii.with_spans(odd(spark), field).collect()
    assert len(out) == len(ROWS) and not any(r.spans for r in out)
    text = odd(spark, [(1, "to ann1@mail.example.com"), (2, None)])
    got = {r.doc_id: r.t for r in text.select("doc_id", pii.redacted_column(field, text["text"]).alias("t")).collect()}
    assert got == {1: "to <EMAIL>", 2: None}


def test_field_reads_long_lines_whole():
    field = pii.Field({"shape (03) 03-04": np.array([0., 0, 0, 9, 0])}, np.zeros((5, 5)))
    phone = "(255) 555-8013"
    for n in range(10, 40):  # the phone lies on either side of multiples of 64 tokens, and across them
        text = "7.25 " * n + phone + " 7.25" * 5
        at = text.index(phone)
        assert ("phone", at, at + len(phone), False) in pii.all_spans(field, text)


def test_field_learns_spelled_out_emails():
    texts = [f"mail hein.{i}@mail{i % 9}.example.com in the {i} of 10.30" for i in range(40)]
    for i, own in enumerate(pii.other_forms("email", "a.b-c.d.19@mail-5.sub.example.co.uk") + ["x@" + "y." * 12 + "z"]):
        assert len(pii.tokens(own)) <= pii.LONGEST_AT
    for parts, _, gold in pii.examples(["write to hein.19@mail5.example.com"])[:5]:
        assert [k for k in gold.values() if k < len(pii.KINDS)] == [pii.KINDS.index("email")]
    field = pii.train(texts)
    email = "hein.19 [at] mail5 [dot] example [dot] com"
    assert ("email", 5, 5 + len(email), False) in pii.all_spans(field, f"mail {email} now")


def corpus(rng, n, bad):
    rows = []
    for i in range(n):
        words = ["".join(rng.choice(["the", "an", "or", "en", "ti"]) for _ in range(rng.randint(1, 4)))
                 for _ in range(rng.randint(20, 80))]
        label = int(rng.random() < 0.4)
        rows.append((bad(words, rng) if label else " ".join(words), label))
    return rows


def test_toxicity_on_held_out_misspellings():
    def insult(words, rng):
        for _ in range(3):
            words[rng.randrange(len(words))] = "vlork" + rng.choice(["ed", "er", "ing", "o", "as", "ux", "ish"])
        return " ".join(words)

    rng = random.Random(4)
    model = tox.train(corpus(rng, 300, insult))

    def score(text):
        words = tox.words_of(text)
        return model.score(tox.stretch_means(model.word_scores(words)) + model.bias)

    clean, unseen = "the anor enti " * 20, "the anor enti " * 10 + "vlorkenth the an vlorkitan or"
    assert score(clean) < 0.5 < score(unseen) and 0 <= score("") < 0.5
    assert tox.train([("a", 1)]) is None


def test_quality_on_held_out_texts():
    rng = random.Random(5)
    model = qc.train(corpus(rng, 300, lambda words, _: " | ".join(w.upper() + "!!" for w in words)))
    compressors = qc.Compressors(model.bad, model.good)
    held = corpus(random.Random(6), 80, lambda words, _: " | ".join(w.upper() + "!!" for w in words))
    right = [(model.score(compressors, t) < 0.5) == y for t, y in held]  # the model's label 1 is the corpus' 1
    assert np.mean(right) > 0.9 or np.mean(right) < 0.1
    assert 0 <= model.score(compressors, None) <= 1 and qc.train([("a", 0), ("b", 0)]) is None


def test_scores_edge_cases(spark):
    labels = spark.createDataFrame([(1, None, 1), (3, 1, 0), (3, 0, 0), (7, 2, 1)], "doc_id long, quality int, toxic int")
    docs = odd(spark)
    for model, add in ((tox.fit_toxicity(docs, labels), tox.with_toxicity), (qc.fit_quality(docs, labels), qc.with_quality)):
        out = add(docs, model).collect()
        assert len(out) == len(ROWS) and all(0 <= r.score <= 1 for r in out)
    assert len(labelled_sample(docs, labels, "quality", 5, 9, 10)) == 2  # both rows of id 3, its larger label
