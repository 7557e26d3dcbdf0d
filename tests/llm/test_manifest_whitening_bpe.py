"""Merkle manifest, whitening and byte-level BPE against brute-force versions,
with nulls, empty and long texts, ties, repeated rows, no rows and clashing columns."""

import collections
import hashlib
import math
import random

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from tidemark.llm import byte_bpe, merkle, whitening
from tidemark.llm.queries import ORACLE_SQL

SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# ---------------------------------------------------------------------- Merkle

DOCS = "doc_id bigint, source string, lang string, n_chars bigint, text string, block string, pos int, STEPS string"


def manifest_rows(n, langs, seed=0):
    r = random.Random(seed)
    return [(i * 3 % 1009, r.choice(["s", None, "é"]), r.choice(langs), r.choice([5, None, 0]),
             r.choice(["", None, "text %d" % i, "x" * r.randint(1, 50)]), "b", 1, "z") for i in range(n)]


def brute_manifest(rows):
    """(doc_id, leaf, subroot, root, siblings) of every row."""
    def leaf(r):
        return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r[:5]))

    def climb(nodes):
        paths, at = [[] for _ in nodes], list(range(len(nodes)))
        while len(nodes) > 1:
            for k, p in enumerate(at):
                if p ^ 1 < len(nodes):
                    paths[k].append(("L" if p & 1 else "R") + nodes[p ^ 1])
                else:
                    paths[k].append("")
            nodes = [sha("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
            at = [p >> 1 for p in at]
        return nodes[0], paths

    runs = collections.defaultdict(list)
    for r in rows:
        runs[r[2]].append((r[0], leaf(r)))
    order = sorted(runs, key=lambda k: (k is not None, (k or "").encode()))
    trees = {}
    for k in order:
        runs[k].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
        trees[k] = climb([d for _, d in runs[k]])
    if not order:
        return []
    root, above = climb([trees[k][0] for k in order])
    return [(i, d, trees[k][0], root, trees[k][1][p] + above[a])
            for a, k in enumerate(order) for p, (i, d) in enumerate(runs[k])]


def test_addresses_are_van_emde_boas():
    assert [a.tolist() for a in merkle.addresses(1)] == [[0], [1, 2]]
    assert [a.tolist() for a in merkle.addresses(3)] == [[0], [1, 2], [3, 6, 9, 12], [4, 5, 7, 8, 10, 11, 13, 14]]
    for h in range(13):
        places = np.concatenate(merkle.addresses(h))
        assert sorted(places) == list(range((2 << h) - 1))


@pytest.mark.parametrize("n", [1, 2, 3, 5, 8, 13, 16, 31])
def test_fill_and_steps(n):
    leaves = [sha(str(i)).encode() for i in range(n)]
    h = (n - 1).bit_length()
    nodes = np.zeros(((2 << h) - 1, 32), np.uint8)
    root = merkle.fill(nodes, 0, h, leaves).decode()
    want = brute_manifest([(i, None, "x", None, None) for i in range(n)])
    level = [d.decode() for d in leaves]
    while len(level) > 1:
        level = [sha("".join(level[i:i + 2])) for i in range(0, len(level), 2)]
    assert root == level[0] and len(want) == n
    for leaf, path in zip(leaves, merkle.steps(nodes, h, n)):
        at = leaf.decode()
        for s in path:
            at = sha(s[1:] + at if s[:1] == "L" else at + s[1:])
        assert at == root


@pytest.mark.parametrize("height", [2, 12])
def test_manifest(spark, height):
    for rows in (manifest_rows(75, ["en", "de", None, "", "zz"]), manifest_rows(1, ["en"]), manifest_rows(9, [None]),
                 manifest_rows(20, ["en"]) + [(None, None, "en", None, None, "b", 1, "z")] * 3 +
                 [(7, "s", "en", 1, "same", "b", 1, "z")] * 4 + [(7, "s", "en", 1, "other", "b", 1, "z")]):
        docs = spark.createDataFrame(rows, DOCS).repartition(3)
        got = merkle.proofs(merkle.manifest(docs, height=height)).collect()
        key = lambda r: (r[0] is not None, r[0] or 0, *r[1:])      # noqa: E731
        assert sorted(((r["doc_id"], r["leaf"], r["subroot"], r["root"], list(r["steps"])) for r in got), key=key) == \
            sorted(brute_manifest(rows), key=key)
    assert merkle.proofs(merkle.manifest(spark.createDataFrame([], DOCS), height=height)).count() == 0


def test_manifest_verifies_and_finds_changes(spark):
    docs = spark.createDataFrame(manifest_rows(60, ["en", "fr"]), DOCS)
    changed = merkle.leaf_digest(
        F.col("doc_id"), F.col("source"), F.col("lang"), F.lit(99), F.col("text"))
    claim = F.when(F.col("doc_id") % 2 == 0, changed)
    rows = merkle.proofs(merkle.manifest(docs, claim, height=2))
    rows = rows.select("doc_id", (merkle.fold(F.coalesce("claim", "leaf"), F.col("steps")) == F.col("root")).alias("ok")).collect()
    assert all(r["ok"] == (r["doc_id"] % 2 == 1) for r in rows)


def test_merkle_query_against_sql(spark):
    from tidemark.llm.merkle import op11_merkle
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    res = con.execute(ORACLE_SQL["op11_merkle"])
    names = [d[0] for d in res.description]
    df = op11_merkle(spark, SF)
    assert sorted(map(tuple, df.select(*names).collect())) == sorted(res.fetchall())


# ------------------------------------------------------------------- whitening

VECTORS = "vec_id bigint, embedding array<double>, label int, x string, N int"


def brute_whitening(rows, k=4):
    take = [(i, [math.floor(256 * c) for c in v]) for i, v in rows
            if v and all(c is not None and math.isfinite(c) for c in v)]
    if not take:
        return None
    x = np.array([v for _, v in take], object)
    fit = np.array(sorted(set(map(tuple, x.tolist()))), object)
    n, s = len(fit), fit.sum(0)
    y = (n * fit - s).astype(float) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    z = ((n * x - s).astype(float) / n) @ vectors[:, :k] / np.sqrt(np.maximum(values[:k], 1e-300))
    return [i for i, _ in take], n, ((n * x - s) ** 2).sum(1).tolist(), z, values, values.sum()


def check_whitening(spark, rows, tmp_path, k):
    path = str(tmp_path)
    spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], VECTORS).repartition(3).write.mode("overwrite").parquet(
        f"{path}/embeddings.parquet")
    got = whitening.op12_whitening(spark, path).collect()
    ids, n, deviation, z, values, trace = brute_whitening(rows, k)
    assert len(got) == len(ids) * k
    assert {r["n"] for r in got} == {n} and {r["component"] for r in got} == set(range(1, k + 1))
    assert sorted((r["vec_id"] is not None, r["vec_id"] or 0, r["deviation"]) for r in got if r["component"] == 1) == \
        sorted((i is not None, i or 0, d if d < 2 ** 63 else None) for i, d in zip(ids, deviation))
    assert all(r["identity_error"] <= 1e-9 for r in got)
    for c in range(k):
        own = sorted((r["vec_id"] is not None, r["vec_id"] or 0, r["whitened"]) for r in got if r["component"] == c + 1)
        want = [sorted((i is not None, i or 0, s * v) for i, v in zip(ids, z[:, c])) for s in (1, -1)]
        assert min(max(abs(a[2] - b[2]) for a, b in zip(own, w)) for w in want) < 1e-8
        assert all(abs(r["explained"] / (values[c] / trace) - 1) < 1e-9 for r in got if r["component"] == c + 1)


def test_whitening(spark, tmp_path):
    r = np.random.default_rng(3)
    spread = np.linspace(3, 0.5, 6)
    rows = [(i, (r.normal(size=6) * spread + 40).tolist()) for i in range(200)]
    odd = [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [math.nan] + [0.0] * 5), (903, [math.inf] + [0.0] * 5), (904, []),
           (5, rows[5][1]), (5, rows[6][1]), (None, rows[7][1]), (None, [40.0] * 6), (905, [-0.0] * 6), *[(906, rows[0][1])] * 50]
    check_whitening(spark, rows + odd, tmp_path, 4)


def test_whitening_large_values(spark, tmp_path):
    r = np.random.default_rng(4)
    spread = np.array([9e12, 5e12, 2e12, 1e12, 1e11])
    check_whitening(spark, [(i, (r.normal(size=5) * spread + 1e13).tolist()) for i in range(60)], tmp_path, 4)


def test_whitening_low_rank(spark, tmp_path):
    r = np.random.default_rng(5)
    check_whitening(spark, [(i, [float(a), float(b), float(a + b)]) for i, (a, b) in enumerate(r.integers(-9, 9, (40, 2)) * [5, 1])],
                    tmp_path, 2)
    equal = spark.createDataFrame([(1, [1.0, 2.0], 1, "x", 2)] * 3, VECTORS)
    assert len(whitening.fit(equal)[0].eigenvalues) == 0
    assert whitening.fit(equal.limit(0)) is None
    equal.write.parquet(f"{tmp_path}/equal/embeddings.parquet")
    assert whitening.op12_whitening(spark, f"{tmp_path}/equal").count() == 0


def test_whitening_lengths(spark):
    rows = [(1, [1.0, 2.0]), (2, [3.0, 5.0]), (3, [1.0]), (4, [1e300, 1.0])]
    got = whitening.quantised(spark.createDataFrame([(i, v, 1, "x", 2) for i, v in rows], VECTORS)).collect()
    assert sorted((r["vec_id"], list(r["x"])) for r in got) == [(1, [256, 512]), (2, [768, 1280])]


@pytest.mark.parametrize("d,rank", [(1, 1), (2, 2), (7, 3), (40, 40), (33, 20)])
def test_components(d, rank):
    r = np.random.default_rng(d)
    a = r.normal(size=(rank, d)) * np.logspace(0, 4, rank)[:, None]
    rows, values = whitening.components(a.T @ a)
    want = np.linalg.svd(a, compute_uv=False) ** 2
    assert len(values) == rank and np.allclose(values, want, rtol=1e-9, atol=1e-14 * want[0])
    assert np.allclose(rows @ rows.T, np.eye(rank), atol=1e-12)
    assert np.allclose(rows @ (a.T @ a), values[:, None] * rows, atol=1e-9 * values[0])
    order, factor = whitening.pivoted_cholesky(a.T @ a)
    assert np.allclose(np.triu(factor[:rank], 1), 0)
    assert np.allclose(factor @ factor.T, (a.T @ a)[np.ix_(order, order)], atol=1e-9 * values[0])


# ------------------------------------------------------------------- byte BPE

VOCABULARY = byte_bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)
ALPHABET = "aabsrevmltd'''   \n\t \u0085\x1c\x1féßñ09²½Ⅷ中文字.,!#😀́​_-　"


@pytest.fixture(scope="module")
def encoding():
    return tiktoken.Encoding("own", pat_str=VOCABULARY.pattern, mergeable_ranks=byte_bpe._ranks(VOCABULARY.content),
                             special_tokens={})


def noise(n, seed, alphabet=ALPHABET):
    r = random.Random(seed)
    return "".join(r.choice(alphabet) for _ in range(n))


def test_scan_equals_the_pattern():
    assert VOCABULARY.pattern == byte_bpe.RUNS
    scan, pattern = byte_bpe.scanner(byte_bpe.RUNS), regex.compile(byte_bpe.RUNS)
    for seed in range(5000):
        t = noise(seed % 15, seed)
        assert scan(t).tolist() == [m.start() for m in pattern.finditer(t)], repr(t)


@pytest.mark.parametrize("pattern", [byte_bpe.RUNS, r"\p{N}{1,3}|\p{L}+|\s+(?!\S)|[^\p{N}\p{L}]"])
def test_stitch(pattern):
    scan = byte_bpe.scanner(pattern)
    for seed in range(1500):
        t = noise(seed % 400, seed, ALPHABET + "a" * (30 * (seed % 3)) + " " * (20 * (seed % 2)) + "7" * (40 * (seed % 5 == 0)))
        chunks = [(at, x, scan(x) + at) for at, x in byte_bpe.cut(t, 40, 25)]
        parts = list(byte_bpe.stitch(chunks, scan, 12))
        assert "".join(p for p, _ in parts) == t
        at, got = 0, []
        for p, starts in parts:
            got += (starts + at).tolist()
            at += len(p)
        assert got == scan(t).tolist()


def test_gather_in_blocks(monkeypatch):
    monkeypatch.setattr(byte_bpe, "GATHER", 3)
    values, ends = np.arange(10), np.array([2, 2, 5, 10])
    out, total = byte_bpe.gather(np.array([3, 1, 0, 2, 0, 3, 1]), values, ends)
    assert out.tolist() == [5, 6, 7, 8, 9, 0, 1, 2, 3, 4, 0, 1, 5, 6, 7, 8, 9] and total.tolist() == [0, 5, 5, 7, 10, 12, 17, 17]


TEXTS = [(1, None), (2, ""), (3, "it's we'll 're <|endoftext|> " + noise(40, 1)), (4, noise(5000, 2)), (5, "a" * 3000), (6, " " * 700 + "x"),
         (7, "7" * 900), (8, "été " * 400), (3, "it's"), (3, "it's"), (None, "null id"), (None, noise(800, 9)), (None, noise(800, 9))]


def bpe_frame(spark, rows):
    return spark.createDataFrame([(i, t, "p", 1) for i, t in rows], "doc_id bigint, text string, part string, AT int").repartition(3)


@pytest.mark.parametrize("chunk,overlap,margin", [(60, 30, 16), (257, 40, 16), (byte_bpe.CHUNK, byte_bpe.OVERLAP, byte_bpe.MARGIN)])
def test_encode_and_decode(spark, encoding, chunk, overlap, margin):
    rows = byte_bpe.decode(byte_bpe.encode(bpe_frame(spark, TEXTS), VOCABULARY, chunk, overlap, margin), VOCABULARY).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, r[1], r[2])      # noqa: E731
    want = [(i, encoding.encode_ordinary(t or ""), (t or "").encode()) for i, t in TEXTS]
    assert sorted(((r["doc_id"], list(r["ids"]), bytes(r["bytes"])) for r in rows), key=key) == sorted(want, key=key)
    assert byte_bpe.decode(byte_bpe.encode(bpe_frame(spark, []), VOCABULARY, chunk, overlap, margin), VOCABULARY).count() == 0


def test_other_pattern(spark):
    pattern = r"\p{N}{1,3}|\p{L}+|[^\p{N}\p{L}]"
    own = byte_bpe.Vocabulary(VOCABULARY.content, pattern)
    other = tiktoken.Encoding("other", pat_str=pattern, mergeable_ranks=byte_bpe._ranks(own.content), special_tokens={})
    rows = byte_bpe.encode(bpe_frame(spark, [(i, t) for i, t in TEXTS if i in (4, 7, 8)]), own, 64, 30, 8).collect()
    texts = dict(TEXTS)
    assert {r["doc_id"]: list(r["ids"]) for r in rows} == {i: other.encode_ordinary(texts[i]) for i in (4, 7, 8)}


def test_decode_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [0, 50255])], "doc_id bigint, ids array<int>")
    by_rank = {v: k for k, v in byte_bpe._ranks(VOCABULARY.content).items()}
    got = {r["doc_id"]: bytes(r["bytes"]) for r in byte_bpe.decode(rows, VOCABULARY).collect()}
    assert got == {1: b"", 2: b"", 3: by_rank[0] + by_rank[50255]}
    with pytest.raises(Exception, match="outside the vocabulary"):
        byte_bpe.decode(spark.createDataFrame([(1, [50256])], "doc_id bigint, ids array<int>"), VOCABULARY).count()


def test_batches_of_texts(encoding, monkeypatch):
    texts = [noise(r % 50, r) for r in range(300)]
    assert byte_bpe._encode_texts(VOCABULARY, pa.array(texts)).to_pylist() == [encoding.encode_ordinary(t) for t in texts]


def test_byte_bpe_query(spark, encoding):
    docs = {r["doc_id"]: r["text"] or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = byte_bpe.op13_byte_bpe(spark, SF).collect()
    assert len(rows) == len(docs)
    for r in rows:
        ids = encoding.encode_ordinary(docs[r["doc_id"]])
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), sha(",".join(map(str, ids))), sha(docs[r["doc_id"]]))
