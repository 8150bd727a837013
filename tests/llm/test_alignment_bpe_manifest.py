"""Tokenizer alignment, byte-level BPE and the Merkle manifest against plain forms of each."""

import base64
import os
import random
import zlib
from collections import Counter
from hashlib import sha256

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from tokenizers import Tokenizer

from placeledger.llm import alignment, byte_bpe
from placeledger.llm.manifest import manifest

SF = "/root/testdata/sf0.001"
given_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars int, batch int, place int, at int, tree string, ids int, rank int"
TEXTS = [
    None, "", " ", "  two  spaces ", "the quick brown fox", "the quick brown fox", "The QUICK", "naïve café — 漢字 😀",
    "a▁b", "<s> </s> <unk> <0x41> <|endoftext|>", "tab\tand\nline\r\n\r\n", "odd space and\x85\x1c", "x" * 3000,
    "ab" * 700 + " c", "I'll we've 'S 123 4567", "\x00\x07", "lorem ipsum dolor " * 20_000, "ﬁ １", "é" * 40,
]


@pytest.fixture
def odd(frame):
    """Odd texts; ids that repeat, are missing, negative or far apart; columns named like the operators' own."""
    ids = [None, 1, 1, 2, 63, 64, -1, -65, 2**62, -2**63, 2**63 - 1, None]
    rows = [{
        "doc_id": ids[k % len(ids)], "text": t, "lang": [None, "en", "", "é"][k % 4], "source": [None, "web"][k % 2],
        "n_chars": None if k % 5 == 0 else k, "batch": 1, "place": 2, "at": 3, "tree": "t", "ids": 4, "rank": 5,
    } for k, t in enumerate(TEXTS + TEXTS[4:9])]
    rows += [rows[0], rows[0], rows[7], rows[7] | {"batch": 9}]
    return frame(rows, SCHEMA)


def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def ordered(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple(map(str, r)))


# 11: tokenizer alignment

def byte_letters():
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


def plain_groups(a, b, letters, text):
    """(left ids, right ids) of each group, by walking over the common ends."""
    if not text:
        return []
    left, right = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    spelled = [[bytes(letters[c] for c in a.id_to_token(i)) for i in left], [
        bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in right]]
    if any(b"".join(s) != (" " + text).encode() for s in spelled):
        return []
    ends = [np.cumsum([len(t) for t in s]).tolist() for s in spelled]
    out, i, j = [], 0, 0
    for end in sorted(set(ends[0]) & set(ends[1])):
        after_i, after_j = ends[0].index(end, i) + 1, ends[1].index(end, j) + 1
        out.append((left[i:after_i], right[j:after_j]))
        i, j = after_i, after_j
    return out


def plain_alignment(docs):
    a = Tokenizer.from_file(public_tokenizers.path(alignment.BYTE_LEVEL))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(alignment.PIECES))
    grouped = [(i, plain_groups(a, b, byte_letters(), t)) for i, t in docs]
    holders, top = Counter(), Counter()
    for _, groups in grouped:
        holders.update({(x, y) for left, right in groups for x in left for y in right})
    for (x, _), n in holders.items():
        top[x] = max(top[x], n)
    for i, groups in grouped:
        links = Counter((x, y) for left, right in groups for x in left for y in right)
        text = ";".join(",".join(map(str, left)) + "|" + ",".join(map(str, right)) for left, right in groups)
        yield (
            i, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), sum(links.values()),
            sum(n for p, n in links.items() if holders[p] == top[p[0]]), sum(n * holders[p] for p, n in links.items()),
            sha256(text.encode()).hexdigest() if text else "")


@pytest.mark.parametrize("batch_bytes", [1, 2000, 1 << 22])
def test_alignment_equals_walking_over_ends(odd, batch_bytes):
    docs = odd.select("doc_id", "text").collect()
    assert ordered(alignment.alignment_digests(odd, batch_bytes=batch_bytes).collect()) == ordered(plain_alignment(docs))


@given_tables
def test_alignment_of_the_given_documents(spark):
    docs = documents(spark)
    assert ordered(alignment.alignment_digests(docs).collect()) == ordered(plain_alignment(docs.select("doc_id", "text").collect()))


def test_alignment_of_nothing(odd):
    assert alignment.alignment_digests(odd.filter("false")).collect() == []
    assert [r["n_links"] for r in alignment.alignment_digests(odd.filter("text = ''")).collect()] == [0]


def test_overlaps_are_the_dense_product():
    rng = np.random.default_rng(5)
    for most in (1, 7, 1 << 20):
        left, right = rng.integers(1, 6, 40), rng.integers(1, 9, 30)
        total = min(left.sum(), right.sum())
        left, right = (np.diff(np.minimum(np.cumsum(np.append(0, x)), total)) for x in (left, right))
        left, right = (np.append(x[x > 0], 0)[:-1] for x in (left, right))
        dense = np.kron(np.eye(1), np.repeat(np.eye(len(left), dtype=int), left, axis=1)) @ np.repeat(np.eye(len(right), dtype=int), right, axis=1).T
        found = np.zeros_like(dense)
        for i, j, shared in alignment.overlaps(left, right, most):
            found[i, j] += shared
        assert (found == dense).all()


def test_product_of_any_matrices():
    rng = np.random.default_rng(6)
    a, b = rng.integers(0, 3, (20, 15)), rng.integers(0, 3, (15, 9))

    def csr(m):
        rows, columns = np.nonzero(m)
        return alignment.Csr(np.concatenate([[0], np.cumsum((m > 0).sum(axis=1))]), columns, m[rows, columns], m.shape[1])

    for most in (1, 10, 1 << 20):
        out = np.zeros((20, 9), dtype=int)
        for i, j, value in csr(a).times(csr(b), most):
            out[i, j] = value
        assert (out == a @ b).all()
    assert (csr(a).transposed().indices == csr(a.T).indices).all()


# 12: byte-level BPE

@pytest.fixture(scope="module")
def encoding():
    with open(public_tokenizers.path(byte_bpe.VOCABULARY), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def plain_digests(docs, encoding):
    for i, text in docs:
        ids = encoding.encode_ordinary(text or "")
        yield (i, len(ids), sha256(np.array(ids, dtype="<u4").tobytes()).hexdigest(), sha256((text or "").encode()).hexdigest())


def test_bpe_equals_the_library(spark, odd, encoding):
    for docs in [odd] + ([documents(spark)] if os.path.isdir(SF) else []):
        got = byte_bpe.bpe_digests(docs)
        assert got.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
        assert ordered(got.collect()) == ordered(plain_digests(docs.select("doc_id", "text").collect(), encoding))
    assert byte_bpe.bpe_digests(odd.filter("false")).collect() == []


def test_trees_alone_and_together(encoding):
    rnd, own = random.Random(2), byte_bpe.vocabulary(byte_bpe.VOCABULARY)
    pieces = ["".join(rnd.choice("abeinrst —é") for _ in range(rnd.randint(1, 24))).encode()[:64] for _ in range(3000)]
    want = [encoding._encode_single_piece(p) for p in pieces]
    assert [byte_bpe.merged(p, own.ranks) for p in pieces] == want
    together = byte_bpe.merged_together(pieces, own.pairs, own.singles)
    for piece, ids, single in zip(pieces, together, want):
        if piece not in own.ranks:
            assert np.frombuffer(ids, "<u4").tolist() == single


def test_long_texts_are_cut_where_no_match_is(encoding, monkeypatch):
    monkeypatch.setattr(byte_bpe, "LONG_TEXT", 50)
    monkeypatch.setattr(byte_bpe, "BLOCK", 3)
    monkeypatch.setattr(byte_bpe, "KEPT", 10)
    own = byte_bpe.ByteBpe(byte_bpe.vocabulary(byte_bpe.VOCABULARY).ranks, public_tokenizers.PATTERN)
    texts = [t for t in TEXTS if t and len(t) < 4000] * 2
    assert [np.frombuffer(i, "<u4").tolist() for i in own.encode(texts)] == [encoding.encode_ordinary(t) for t in texts]


def test_ids_of_half_a_character_decode_to_its_bytes(frame):
    ids = byte_bpe.vocabulary(byte_bpe.VOCABULARY).singles[[0xC3]].astype("<u4").tobytes()
    rows = byte_bpe.decode_ids(frame([{"doc_id": 1, "ids": ids}, {"doc_id": 2}], "doc_id int, ids binary")).collect()
    assert sorted((r["doc_id"], bytes(r["decoded"])) for r in rows) == [(1, b"\xc3"), (2, b"")]


# 13: Merkle manifest

def plain_manifest(rows):
    """Every level of every tree in lists."""
    def h(text):
        return sha256(text.encode()).hexdigest()

    def leaf(r, text):
        values = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
        return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([h("".join(out[-1][i:i + 8])) for i in range(0, len(out[-1]), 8)])
        return out

    def way(tree, place):
        for level in tree[:-1]:
            start = place // 8 * 8
            yield "".join(level[start:place]), "".join(level[place + 1:start + 8])
            place //= 8

    low = {c: c + 32 for c in range(65, 91)}
    trees = {}
    for r in rows:
        changed = zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3 == 0
        other = leaf(r, r["text"] and r["text"].translate(low)) if changed else None
        trees.setdefault(r["lang"], []).append((r["doc_id"], leaf(r, r["text"]), other))
    names = sorted(trees, key=lambda g: (g is not None, (g or "").encode()))
    for g in names:
        trees[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1]))
    built = {g: levels([x[1] for x in trees[g]]) for g in names}
    top = levels([built[g][-1][0] for g in names])
    for k, g in enumerate(names):
        for p, (i, own, other) in enumerate(trees[g]):
            node, proof = other or own, ""
            for a, b in [*way(built[g], p), *way(top, k)]:
                proof, node = proof + a + b, h(a + node + b)
            yield (i, own, built[g][-1][0], top[-1][0], h(proof), node, node == top[-1][0])


def same_manifest(df):
    got = manifest(df).collect()
    assert ordered(got) == ordered(plain_manifest([r.asDict() for r in df.collect()]))
    return got


def test_manifest_of_odd_rows(odd):
    same_manifest(odd)


def test_manifest_of_few_rows(odd):
    one = same_manifest(odd.limit(1))
    assert one[0]["root"] == one[0]["leaf"] and one[0]["proof_sha256"] == sha256(b"").hexdigest()
    assert manifest(odd.filter("false")).collect() == []


def test_manifest_of_many_levels(spark):
    """More leaves than a span has, one hot group, many small ones, ids that many rows share."""
    rows = spark.range(13_000).selectExpr(
        "if(id % 7 = 0, 5, id * id % 100003) AS doc_id", "concat('Text ', id % 4000) AS text",
        "if(id % 9 = 0, concat('g', id % 99), 'hot') AS lang", "'s' AS source", "cast(id % 2 AS int) AS n_chars")
    got = same_manifest(rows)
    assert {r["verified"] for r in got} == {True, False}


def test_manifest_tells_what_tampering_did(odd):
    changed = {"n_chars": lambda c: c + 1}
    rows = manifest(odd, altered=changed, tampered=lambda i: i == 63).collect()
    assert {r["verified"] for r in rows if r["doc_id"] != 63} == {True}
    assert {r["verified"] for r in rows if r["doc_id"] == 63} == {False}
