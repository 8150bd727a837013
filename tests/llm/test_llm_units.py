"""The parts of the operators that need no session, against plain versions."""

import random
import tracemalloc

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import xxhash
from hypothesis import given, settings, strategies as st
from tokenizers import Tokenizer

from placeledger.llm import tokens
from placeledger.llm.common import slices, smallest_reachable
from placeledger.llm.copies import similar_groups
from placeledger.llm.langid import BITS, LanguageModel, counts, judged, train as train_languages
from placeledger.llm.lm import Batch, learn_weights, packed, packed_counts, unpacked, unpacked_counts
from placeledger.llm.packing import piece_lengths
from placeledger.llm.simhash import ALL, bucket_keys, bucket_links, fingerprint, near_pairs, planes_of, within_radius
from placeledger.llm.token_file import EliasFano
from placeledger.llm.tokens import token_ids
from placeledger.llm.toxicity import features_of, swapped, train as train_toxicity
from placeledger.llm.vectors import join_tile


def reached(n, pairs):
    group = list(range(n))
    for a, b in pairs:
        low, high = sorted((group[a], group[b]))
        group = [low if g == high else g for g in group]
    return [min(i for i in range(n) if group[i] == g) for g in group]


@given(st.integers(1, 30).flatmap(lambda n: st.tuples(st.just(n), st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1))))))
@settings(max_examples=60, deadline=None)
def test_smallest_reachable(case):
    n, pairs = case
    left, right = (np.array([p[k] for p in pairs], dtype=int) for k in (0, 1))
    assert smallest_reachable(n, left, right).tolist() == reached(n, pairs)


def test_slices_cover_everything_once():
    sizes = np.array([3, 0, 9, 1, 1, 1])
    assert list(slices(sizes, 4)) == [(0, 3), (3, 6)]
    assert list(slices(np.array([], dtype=int), 4)) == []


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 5, 7])
def test_bit_sliced_distances(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 63, 150, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, k, replace=False)) for k in rng.integers(0, 9, 150)], dtype=np.uint64)
    codes = np.concatenate([base, base ^ flips])
    i, j = near_pairs(codes, codes, radius)
    wanted = {(a, b) for a in range(300) for b in range(300) if int(codes[a] ^ codes[b]).bit_count() <= radius}
    assert set(zip(i.tolist(), j.tolist())) == wanted
    # Codes within the radius agree in the masked bits of some bucket key.
    masks = [np.uint64(m % (1 << 64)) for m, _ in bucket_keys(radius)]
    assert all(any(codes[a] & m == codes[b] & m for m in masks) for a, b in wanted)


def test_bucket_links_stay_inside_buckets_and_cross_sides():
    codes = np.array([1, 3, 7, 1, 255, 1, 2, 1 << 40], dtype=np.uint64)
    bucket = np.array([5, 5, 5, 6, 6, 9, 9, 9])
    side = np.array([0, 0, 0, 0, 0, 0, 1, 1])
    i, j = bucket_links(bucket, side, codes, 2)
    assert sorted(zip(i.tolist(), j.tolist())) == [(1, 0), (2, 0), (6, 5), (7, 5)]


def test_blocks_that_are_over_are_abandoned():
    rng = np.random.default_rng(8)
    codes = rng.integers(0, 1 << 63, 512, dtype=np.uint64) << np.uint64(1)
    planes = planes_of(codes)
    place = np.arange(512)
    later = np.packbits(place[None, :] > place[:, None], axis=1, bitorder="little").view("<u8")
    near, steps = within_radius(codes, planes, 3, later)
    assert not near.any()
    # Half of the words are open, and most of them are over long before the last plane.
    assert steps < 64 * later.size * 0.3
    runs = np.packbits((place[None, :] > place[:, None]) & (place[None, :] // 8 == place[:, None] // 8), axis=1, bitorder="little").view("<u8")
    assert within_radius(codes, planes, 3, runs)[1] < 64 * runs.size * 0.06
    # Bits that are not asked for are not read.
    near, steps = within_radius(codes, planes, 3, bits=0b1011)
    assert steps <= 3 * near.size and (near == ALL).all() == ((codes & np.uint64(0b1011)) < 16).all()


@pytest.mark.parametrize("crossing", [False, True])
def test_a_large_group_of_near_codes_is_folded_block_by_block(crossing):
    rng = np.random.default_rng(2)
    codes = np.uint64(1) << rng.integers(0, 64, 3000, dtype=np.uint64)
    side = (np.arange(3000) >= 1500).astype(int) if crossing else np.zeros(3000, dtype=int)
    tracemalloc.start()
    i, j = bucket_links(np.zeros(3000, dtype=int), side, codes, 2)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert sorted(i.tolist()) == list(range(1, 3000)) and not j.any()
    # All pairs would be 36 MB (crossing) or 144 MB of indexes, and as much again when joined.
    assert peak < (70 << 20 if crossing else 130 << 20)


@pytest.mark.parametrize("text", ["", None, " \t", "One", "a B", "x y z", "x y z x y z x", "É é a\x0bb  c\n" * 40])
def test_fingerprint_by_hand(text):
    words = [w for w in (text or "").translate({c: c + 32 for c in range(65, 91)}).encode().split() if w]
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) > 2 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    assert fingerprint(text, 3) == sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


@given(st.lists(st.sets(st.integers(0, 12), max_size=9), max_size=14), st.sampled_from([0.3, 0.5, 0.8, 1.0]))
@settings(max_examples=150, deadline=None)
def test_similar_groups(sets, similarity):
    pairs = [(a, b) for a in range(len(sets)) for b in range(a)
             if sets[a] & sets[b] and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]) - 1e-9]
    arrays = [np.array(sorted(s), dtype="<u8") for s in sets]
    assert similar_groups(arrays, similarity).tolist() == reached(len(sets), pairs)


PARTS = [*"aAbB é ñ,.'\"!?() 1234-_\n\n\t", "\r\n", "'s", "'ll", "<|endoftext|>", "<|ENDOFTEXT|>", "<|startoftext|>", "  ", "\xa0", " ", "日本", "́", "\x1c", "Σ", "🙂", " . "]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunked_ids_equal_whole_texts(name, monkeypatch):
    monkeypatch.setattr(tokens, "KEPT", 50)
    monkeypatch.setattr(tokens, "KEPT_ONCE", 20)
    whole, rng = Tokenizer.from_file(public_tokenizers.path(name)), random.Random(4)
    for _ in range(3000):
        text = "".join(rng.choices(PARTS, k=rng.randint(0, 16)))
        assert token_ids(text, name) == np.array(whole.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes(), text
    assert token_ids(None, name) == b""


@given(st.integers(0, 9000), st.sampled_from([1, 2, 64, 2048]))
@settings(max_examples=80, deadline=None)
def test_pieces_are_powers_of_two_that_add_up(n, longest):
    pieces = piece_lengths(n, longest)
    assert sum(pieces) == n and pieces == sorted(pieces, reverse=True)
    assert all(p & (p - 1) == 0 and p <= longest for p in pieces)
    assert len({p for p in pieces if p < longest}) == len([p for p in pieces if p < longest])


@given(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 5000), st.integers(0, 1 << 33)), max_size=200))
@settings(max_examples=80, deadline=None)
def test_elias_fano_returns_every_number(gaps):
    values = np.cumsum(np.array(gaps, dtype=np.int64))
    ef = EliasFano.of(values)
    assert ef[np.arange(len(values))].tolist() == values.tolist()
    if len(values):
        assert ef[np.array([len(values) // 2])].tolist() == [values[len(values) // 2]]


def test_elias_fano_is_small():
    values = np.cumsum(np.random.default_rng(0).integers(1, 1000, 50_000))
    ef = EliasFano.of(values)
    assert 8 * (len(ef.low) + len(ef.high) + len(ef.ranks)) < 1.15 * len(values) * (2 + np.log2(500))


def test_packed_numbers_return():
    for kind in ("<u4", "<u8"):
        numbers = np.array([0, 1, 255, 256, 1 << 31], dtype=kind)
        assert unpacked(packed(numbers), kind).tolist() == numbers.tolist()
    assert unpacked(packed(np.array([], dtype="<u8")), "<u8").tolist() == []
    for counts in ([], [0, 255], [256, 1], [1 << 16], [1 << 40, 7]):
        assert unpacked_counts(packed_counts(np.array(counts, dtype=np.uint64))).tolist() == counts


@pytest.mark.parametrize("order", [1, 2, 3])
def test_batch_keeps_texts_apart(order):
    both, alone = Batch([b"a b", b"", b"A  c a b"], order), Batch([b"a b"], order)
    assert both.sizes.tolist() == [3, 1, 5]
    for k in range(order):
        keys = both.keys[k]
        first, third = both.first[0], both.first[2]
        assert keys[first:first + 3].tolist() == alone.keys[k][alone.first[0]:alone.first[0] + 3].tolist()
        # "a b <end>" ends both texts, with no text's words in the other's n-grams.
        assert keys[third + 4] == keys[first + 2]


def test_weights_sum_to_one_and_unseen_contexts_have_no_longest_order():
    cells = [{"bucket": 0, "n": 10.0, "sum0": 1.0, "sum1": 0.0}, {"bucket": 3, "n": 90.0, "sum0": 0.9, "sum1": 45.0},
             {"bucket": 3, "n": 10.0, "sum0": 1.0, "sum1": 0.0}]
    weights = learn_weights(cells, 2, 1e-4)
    assert np.allclose(weights.sum(axis=1), 1) and weights[0, 2] == 0
    assert weights[3, 2] > 0.8 and (weights[4:] == weights[3]).all()
    assert np.allclose(learn_weights([], 2, 1e-4).sum(axis=1), 1)


def test_weights_are_those_of_a_plain_em():
    rng = np.random.default_rng(1)
    cells = [{"bucket": 5, "n": float(n), "sum0": n * a, "sum1": n * b}
             for n, a, b in zip(rng.integers(1, 50, 30), rng.random(30) * 1e-3, rng.random(30) * 0.5)]
    mix = [1 / 3] * 3
    for _ in range(50):
        share = [0.0] * 3
        for c in cells:
            estimate = [1e-4, c["sum0"] / c["n"], c["sum1"] / c["n"]]
            total = sum(m * e for m, e in zip(mix, estimate))
            share = [s + c["n"] * m * e / total for s, m, e in zip(share, mix, estimate)]
        mix = [s / sum(share) for s in share]
    assert np.allclose(learn_weights(cells, 2, 1e-4)[5], np.maximum(mix, 1e-6) / np.maximum(mix, 1e-6).sum(), atol=1e-9)


def language_rows():
    rng = random.Random(1)
    vocab = {"aa": ["kapo", "lumi", "tola", "veka"], "bb": ["schwer", "zwischt", "nicht", "uber"], "cc": ["été", "où", "çaille", "même"]}
    texts = [(lang, " ".join(rng.choices(vocab[lang], k=rng.randint(3, 30)))) for lang in vocab for _ in range(60)]
    return sorted(vocab), texts


def test_language_model_learns_and_rejects():
    languages, rows = language_rows()
    model = train_languages(
        np.array([counts(t) for _, t in rows], dtype=np.float32), np.array([languages.index(k) for k, _ in rows]), languages)
    named, score, rejected = judged(model, [t for _, t in rows] + [None, "", "123 ,.!", "KAPO Lumi tola"])
    assert named[:len(rows)] == [k for k, _ in rows] and not rejected[:len(rows)].any()
    assert named[-4:-1] == ["und"] * 3 and rejected[-4:-1].all() and score[-4:-1].tolist() == [0, 0, 0]
    assert named[-1] == "aa" and not rejected[-1]
    assert ((score >= 0) & (score <= 1)).all()


def test_scores_do_not_depend_on_neighbours_or_length():
    model = LanguageModel(["x", "y"], np.random.default_rng(0).normal(size=((1 << BITS) + 1, 2)).astype(np.float32), np.zeros(2), 1.0, 0.1)
    model.rows[-1] = 0
    texts = ["one two", "", "drei vier fünf", "long " * 500_000]
    together = model.scores(texts)
    for text, row in zip(texts, together):
        assert np.allclose(model.scores([text])[0], row, atol=1e-4)


def test_a_rejection_threshold_applies():
    model = LanguageModel(["x", "y"], np.zeros(((1 << BITS) + 1, 2), dtype=np.float32), np.zeros(2), 1.0, 0.6)
    assert judged(model, ["abc"])[2].tolist() == [True]
    assert judged(None, ["abc"])[0] == ["und"]


def toxic_rows(n=300):
    """Insults decide the label; group mentions are commoner in toxic texts, as in real labels."""
    rng = random.Random(2)
    words, insults, groups = [f"w{chr(97 + k)}x" for k in range(20)], ["vile", "rotten"], ["muslims", "women", "christians"]
    texts, labels = [], []
    for k in range(n):
        toxic = k % 2
        text = rng.choices(words, k=12)
        if rng.random() < (0.9 if toxic else 0.1):
            text.append("muslims")
        elif rng.random() < 0.5:
            text.append(rng.choice(groups[1:]))
        if toxic and rng.random() < 0.8:
            text.append(rng.choice(insults))
        texts.append(" ".join(text))
        labels.append(toxic)
    return texts, np.array(labels)


def test_swaps_stop_group_mentions_from_scoring():
    texts, labels = toxic_rows()
    docs = [features_of(t) for t in texts]
    plain, fair = (train_toxicity(docs, labels, 0.5, [swapped(t) for t in texts], penalty=p) for p in (0.0, 4.0))
    pairs = [["wax wbx muslims", "wax wbx women"], ["wcx muslims wdx", "wcx christians wdx"]]
    gap = [np.mean([abs(np.subtract(*m.scores(p))) for p in pairs]) for m in (plain, fair)]
    assert gap[1] < 0.2 * gap[0]
    assert fair.scores(["wax wbx muslims"])[0] < plain.scores(["wax wbx muslims"])[0]
    assert (fair.scores(["wax vile women", "wbx rotten"]) > 0.5).all()


def test_mentions_are_swapped_form_by_form():
    def found(text):
        return features_of(text).tolist()

    def swaps(text):
        return [s.tolist() for s in swapped(text)]

    assert swaps(None) == [] and swaps("no group is named") == []
    assert found("the man spoke") in swaps("The Woman spoke.") and found("the men spoke") not in swaps("The Woman spoke.")
    assert found("les hommes") in swaps("les musulmans")
    assert found("die Christen") in swaps("die Muslime") and found("die Frauen") in swaps("die Muslime")
    assert found("une loi juive") in swaps("une loi islamique")
    # A text that holds the other name already has it once.
    assert swaps("muslims, christians")[0] == found("christians, muslims")


def test_toxic_scores_of_odd_texts():
    texts, labels = toxic_rows(100)
    model = train_toxicity([features_of(t) for t in texts], labels, 0.5)
    long = "wax " * 400_000
    scores = model.scores([None, "", "!!", long, long + "vile", "VILE wax", "vile wax"])
    assert ((scores >= 0) & (scores <= 1)).all() and scores[0] == scores[1] == scores[2]
    assert scores[4] > scores[3] and np.isclose(scores[5], scores[6])
    assert model.scores([]).tolist() == []


def test_vector_tile_counts_and_joins():
    unit = np.eye(3)[[0, 0, 1, 2, 0]] + np.array([0, 0.01, 0, 0, 0.02])[:, None]
    table = pa.table({
        "cls": [4, 7, 5, 6, 9], "size": [1, 3, 1, 1, 2], "home": [True, True, True, True, False], "side": [0] * 5,
        "width": pa.array([3] * 5, pa.int32()), "v": pa.array(unit.tolist(), pa.list_(pa.float64())),
    })
    out = join_tile(table, 0.95).to_pylist()
    assert {(r["a"], r["n"]) for r in out if r["b"] is None} == {(4, 5), (7, 3), (9, 4)}
    assert {(r["a"], r["b"]) for r in out if r["b"] is not None} == {(7, 4), (9, 4)}
