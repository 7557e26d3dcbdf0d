"""Language identification against a brute-force kernel machine; redaction of
texts with very many secrets."""

import random
import time
import zlib

import numpy as np
import pytest

from tidemark.llm import language, rolling, secrets
from tidemark.llm.language import op8_language

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string"


def word(seed):
    r = random.Random(seed)
    return "".join(r.choice("abcdefghijklmnop") for _ in range(12))


@pytest.mark.parametrize("null_ids", [False, True])
def test_languages_of_one_text_are_kept(spark, null_ids):
    """60 languages, each one text repeated in all its rows, also without any doc_id."""
    rows = [(None if null_ids else k * 300 + i, word(k), f"l{k:02d}") for k in range(60) for i in range(300)]
    rows += [(None, word(99), None), (None, "123", "digits")]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    picked = language.sample(docs)
    counts = {k: sum(1 for x, _ in picked if x == k) for k, _ in picked}
    assert len(counts) == 60 and set(counts.values()) == {language.MAX_ROWS // 60}
    model = language.train(picked)
    found = language.predict(spark.createDataFrame([(k, word(k), None) for k in range(60)], SCHEMA), model).collect()
    assert all(r["lang_pred"] == f"l{r['doc_id']:02d}" for r in found)


def test_sample_is_bounded_and_whole_for_few_rows(spark):
    rows = [(i, f"text {i % 7}", "big") for i in range(5000)] + [(i, "le petit", "small") for i in range(6000, 6012)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    picked = [k for k, _ in language.sample(docs, per_language=50)]
    small = sum(1 for i in range(6000, 6012) if zlib.crc32(str(i).encode()) % 4 != 2)
    assert picked.count("big") == 50 and picked.count("small") == small
    assert language.sample(docs, per_language=50) == language.sample(docs.repartition(5), per_language=50)


def cells(text):
    """N-gram cells of a text, gram by gram."""
    data, out = text.lower().encode(), set()
    for n in language.GRAMS:
        for k in range(len(data) - n + 1):
            gram = np.frombuffer(data[k:k + n], np.uint8)
            h = rolling.window_hash(rolling.byte_prefix(gram), n)[:1] + np.uint64(n)
            out.add(int(rolling.mix(h)[0] >> np.uint64(64 - language.BUCKET_BITS)))
    return out


def kernel(a, b):
    return len(a & b) / np.sqrt(max(len(a), 1) * max(len(b), 1))


def brute_scores(train, marks, texts):
    """Scores of one-versus-rest ridge regression on Nystroem features, all in loops."""
    names = sorted({k for k, _ in train})
    sets, land = [cells(t) for _, t in train], [cells(t) for t in marks]
    weight = np.array([1 / sum(1 for k, _ in train if k == own) for own, _ in train])
    a = np.array([[kernel(s, m) for m in land] for s in sets])
    b = np.array([[kernel(x, m) for m in land] for x in land])
    out = []
    for name in names:
        y = np.array([1.0 if k == name else -1.0 for k, _ in train])
        left = a.T @ np.diag(weight) @ a + language.RIDGE * (b + 1e-6 * np.eye(len(land)))
        alpha = np.linalg.solve(left, a.T @ (weight * y))
        out.append([sum(kernel(cells(t), m) * c for m, c in zip(land, alpha)) for t in texts])
    return names, np.array(out).T


def test_query_against_brute_force(spark, tmp_path):
    """The registered query: every training row is learned from and is a landmark."""
    r = random.Random(8)
    books = {k: [word(f"{k}{i}")[:r.randint(2, 8)] for i in range(40)] for k in ("aa", "bb", "cc")}
    rows = [(i, " ".join(r.choice(books[k]) for _ in range(r.randint(1, 30))).title(), k)
            for i, k in enumerate(r.choice(list(books)) for _ in range(44))]
    rows += [(100, None, "aa"), (101, "", "bb"), (102, "12 !", "cc"), (103, "É" * 9, None), (None, rows[0][1], None)]
    spark.createDataFrame([(i, t, k, "s", 1.0) for i, t, k in rows], SCHEMA + ", source string, score double").repartition(3) \
        .write.parquet(f"{tmp_path}/documents.parquet")
    train = [(k, t) for i, t, k in rows if k and t and any(c.isalpha() for c in t) and (
        i is None or zlib.crc32(str(i).encode()) % 4 != 2)]
    assert max(sum(1 for k, _ in train if k == x) for x in books) <= language.LANDMARKS
    texts = [t for _, t, _ in rows if t and any(c.isalpha() for c in t)]
    names, scores = brute_scores(train, [t for _, t in train], texts)
    want = {t: (names[s.argmax()], (np.clip(s.max(), -1, 1) + 1) / 2) for t, s in zip(texts, scores)}
    by_id = {i: t for i, t, _ in rows}
    got = op8_language(spark, str(tmp_path)).collect()
    assert len(got) == len(rows)
    for row in got:
        lang, score = want.get(by_id[row["doc_id"]], ("und", 0.0))
        assert row["lang_pred"] == lang and abs(row["score"] - score) < 2e-3
        assert row["held_out"] == (row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 4 == 2)


def test_more_languages_than_landmarks(spark):
    rows = [(f"l{k:03d}", np.packbits(language.presence([word(k)]), axis=1)[0].tobytes()) for k in range(40)]
    old, language.MAX_LANDMARKS = language.MAX_LANDMARKS, 10
    try:
        model = language.train(rows)
    finally:
        language.MAX_LANDMARKS = old
    assert len(model.languages) == 40 and model.landmarks.shape[1] == 10


# ------------------------------------------------------------------- redaction

def redacted(text, spans, mark="[SECRET]"):
    out, at = [], 0
    for a, b in spans:
        if a > at or not out:
            out.append(text[at:a])
            out.append(mark)
        at = max(at, b)
    return "".join(out) + text[at:]


@pytest.mark.parametrize("n", [1, 255, 256, 257, 512, 700])
def test_redaction_around_block_borders(spark, n):
    text = "".join(f"é{k} token={'x' * (8 + k % 3)}, " for k in range(n)) + "end"
    df = spark.createDataFrame([(1, text), (2, None), (3, ""), (4, text.removesuffix(", end"))], "doc_id bigint, text string")
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["_spans"]] for r in secrets.find_secrets(df).collect()}
    assert len(spans[1]) == n
    got = {r["doc_id"]: r["text"] for r in secrets.redact(df).collect()}
    assert got == {1: redacted(text, spans[1]), 2: None, 3: "", 4: redacted(text.removesuffix(", end"), spans[4])}
    assert "xxxxxxxx" not in got[1]


def test_redaction_is_linear_in_spans(spark):
    """160,000 secrets in one text."""
    text = "pwd token=abcdefgh\n" * 160_000
    df = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    secrets.redact(df.limit(0)).collect()
    t = time.time()
    (row,) = secrets.redact(df).collect()
    assert row["text"] == "pwd [SECRET]\n" * 160_000
    assert time.time() - t < 60
