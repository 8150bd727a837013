"""The operators on small tables: brute force, nulls, odd texts, ties, repeats, empty tables."""

import math
import os
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from placeledger.llm import lm
from placeledger.llm.copies import first_copies, shingle_set, similar_groups
from placeledger.llm.decontaminate import contained_items
from placeledger.llm.langid import identify_languages, predict_languages
from placeledger.llm.packing import pack, piece_digests, write_buckets
from placeledger.llm.preferences import format_preferences
from placeledger.llm.queries import QUERIES
from placeledger.llm.shards import external_shuffle, scatter, shard_digests
from placeledger.llm.simhash import fingerprint, simhash_components
from placeledger.llm.sql import ORACLES
from placeledger.llm.token_file import token_digests
from placeledger.llm.toxicity import classify_toxicity
from placeledger.llm.vectors import vector_components
from workload.verify import TABLES, rows_of

SF = "/root/testdata/sf0.001"
given_tables = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")
LONG = "lorem ipsum dolor " * 20_000
ODD = [
    (1, "the quick brown fox jumps over the lazy dog", "en"), (1, "the quick brown fox jumps over the lazy dog", "en"),
    (2, "The QUICK brown fox jumps over the lazy dog", None), (3, "", "en"), (4, None, None), (None, None, "fr"),
    (None, "le renard brun saute", "fr"), (5, " \t\n", "fr"), (6, LONG, "la"), (7, "123 456", "en"), (8, "x", "en"),
    (1, "another text under the same id", "en"),
]


@pytest.fixture
def odd(frame):
    """Odd rows, with columns named like the operators' own."""
    rows = [{"doc_id": i, "text": t, "lang": g, "size": 1, "shard": 2, "batch": 3, "fp": 4, "_key": 5} for i, t, g in ODD]
    return frame(rows, "doc_id long, text string, lang string, size int, shard int, batch int, fp int, _key int")


@pytest.fixture
def none(odd):
    return odd.filter("false")


def table(spark, name):
    return spark.read.parquet(f"{SF}/{name}.parquet")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


@given_tables
@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = duck.execute(ORACLES[name])
    assert got == rows_of([d[0] for d in result.description], result.fetchall())


def test_a_query_for_every_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


def native(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


# 1: language-model scores

def plain_scores(docs, order, weights):
    """All columns by dictionaries of counts, with the given mixture weights."""
    low = {c: c + 32 for c in range(65, 91)}
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(low)) + ["\n"]) for i, t in docs]
    learned = [zlib.crc32(("" if i is None else str(i)).encode()) % 10 != 0 for i, _ in texts]
    count = [Counter() for _ in range(order)]
    for (_, words), train in zip(texts, learned):
        row = ["<s>"] * (order - 1) + words
        for p in range(max(order - 2, 0), len(row)) if train else []:
            for k in range(1, order + 1):
                if p >= order - 1 or k < order:
                    count[k - 1][tuple(row[p - k + 1:p + 1])] += 1
    known = {k[0]: c for k, c in count[0].items() if k[0] != "<s>"}
    tokens, types = sum(known.values()), len(known)
    for (i, words), train in zip(texts, learned):
        row, score = ["<s>"] * (order - 1) + words, 0.0
        for p in range(order - 1, len(row)):
            parts, seen = [1 / (types + 1), known.get(row[p], 0) / max(tokens, 1)], tokens
            for k in range(2, order + 1):
                seen = count[k - 2][tuple(row[p - k + 1:p])]
                parts.append(count[k - 1][tuple(row[p - k + 1:p + 1])] / seen if seen else 0)
            bucket = min(int(math.log2(seen)) + 1, lm.CONTEXT_BUCKETS - 1) if seen else 0
            score += math.log10(sum(a * b for a, b in zip(parts, weights[bucket])))
        base = sum(math.log10((known.get(w, 0) + 0.1) / (tokens + 0.1 * (types + 1))) for w in words)
        yield (i, not train, len(words), sum(w in known for w in words), tokens, round(base, 5), round(score, 5))


@pytest.mark.parametrize("order", [1, 2, 3])
@pytest.mark.parametrize("source", ["odd", "documents", "none"])
def test_scores_equal_dictionaries(spark, odd, none, order, source, monkeypatch):
    if source == "documents" and not os.path.isdir(SF):
        pytest.skip("driver tables are not here")
    docs = {"odd": odd, "none": none}.get(source) or table(spark, "documents")
    learned = {}
    learn = lm.learn_weights
    monkeypatch.setattr(lm, "learn_weights", lambda *a: learned.setdefault("w", learn(*a)))
    got = [(*r[:5], round(r[5], 5), round(r[6], 5)) for r in lm.score_texts(docs, order).collect()]
    rows = [(r[0], r[1]) for r in docs.select("doc_id", "text").collect()]
    assert sorted(got, key=repr) == sorted(plain_scores(rows, order, learned["w"]), key=repr)


@given_tables
def test_the_mixture_beats_the_base_on_held_out_texts(spark):
    row = lm.score_texts(table(spark, "documents")).filter("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert row[0] > 0.85 * row[1]


@given_tables
def test_scores_do_not_depend_on_partitions(spark):
    docs, before = table(spark, "documents"), spark.conf.get("spark.sql.shuffle.partitions")
    found = []
    try:
        for parts in (1, 4, 64):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            found.append({r["doc_id"]: r["score"] for r in lm.score_texts(docs).collect()})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(found[0]) == 200
    for other in found[1:]:
        assert all(math.isclose(score, other[i], rel_tol=1e-9) for i, score in found[0].items())


# 2: preferences

def test_preference_edges(frame):
    rows = [
        *[{"pair_id": 1, "side": s, "turn": t, "role": r, "text": x} for s, t, r, x in [
            ("chosen", 0, "user", "hi"), ("chosen", 1, "assistant", "good"), ("rejected", 0, "user", "hi"), ("rejected", 1, "assistant", "bad")]],
        {"pair_id": 2, "side": "chosen", "turn": 0, "role": "user", "text": None},
        {"pair_id": 3, "side": "chosen", "turn": 0, "role": "user", "text": "a"}, {"pair_id": 3, "side": "rejected", "turn": 0, "role": "user", "text": "a"},
        {"pair_id": None, "side": "rejected", "turn": None, "role": None, "text": "z"},
        {"pair_id": 4, "side": "other", "turn": 0, "role": "user", "text": "left out"},
    ]
    turns = frame(rows, "pair_id long, side string, turn long, role string, text string").withColumn("prompt", F.lit("clash"))
    out = {r["pair_id"]: r for r in format_preferences(turns).collect()}
    assert set(out) == {1, 2, 3, None}
    one = out[1]
    assert (one["n_prompt_turns"], one["prompt"]) == (1, "<|user|>\nhi<|end|>\n")
    assert (one["chosen"], one["rejected"]) == ("<|assistant|>\ngood<|end|>\n", "<|assistant|>\nbad<|end|>\n")
    assert [tuple(m) for m in one["chosen_mask"]] == [(14, False), (12, True)]
    assert (out[2]["prompt"], out[2]["chosen"], out[2]["rejected"]) == ("", "<|user|>\n<|end|>\n", "")
    assert (out[3]["n_prompt_turns"], out[3]["chosen"], out[3]["rejected"]) == (1, "", "")
    assert out[None]["rejected"] == "<||>\nz<|end|>\n"
    assert format_preferences(turns.filter("false")).collect() == []


# 3: external shuffle

def test_shards(spark, odd, none):
    rows = shard_digests(odd, 4, bucket_bytes=100).collect()
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == Counter(
        (i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t, _ in ODD)
    slots = {}
    for r in rows:
        slots.setdefault(r["shard"], []).append(r["slot"])
        assert r["grown_shard"] in (r["shard"], 4) and r["law"] == "key"
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert len({(r["doc_id"], r["shard"]) for r in rows}) == len({r["doc_id"] for r in rows})
    assert shard_digests(none, 4).collect() == []


def test_one_more_shard_takes_rows_only_into_itself(spark):
    docs = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    before, after = (dict(external_shuffle(docs, n).select("doc_id", "shard").collect()) for n in (10, 11))
    grown = dict(external_shuffle(docs, 10).select("doc_id", "grown_shard").collect())
    assert grown == after and all(after[i] in (before[i], 10) for i in before)
    counts = Counter(before.values())
    assert max(counts.values()) < 1.25 * min(counts.values())


def test_rows_without_an_id_share_a_shard_but_not_a_bucket(spark, frame):
    docs = frame([{"doc_id": None, "text": f"text {i} " * 20} for i in range(400)], "doc_id long, text string")
    rows = scatter(docs, 4, 4000, 17).select("shard", "bucket").collect()
    sizes = [n for _, n in Counter((r["shard"], r["bucket"]) for r in rows).items()]
    assert len({r["shard"] for r in rows}) == 1 and len(sizes) > 10 and max(sizes) < 100
    shards = shard_digests(docs, 4, bucket_bytes=4000).collect()
    assert sorted(r["slot"] for r in shards) == list(range(400))


def test_order_is_shuffled_and_repeatable(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    first, again = (external_shuffle(docs, 2, 8000).orderBy("shard", "slot").collect() for _ in range(2))
    assert first == again
    ids = [r["doc_id"] for r in first if r["shard"] == 0]
    assert abs(np.corrcoef(ids, range(len(ids)))[0, 1]) < 0.15


def test_shuffle_and_search_run_without_python(spark, odd, frame):
    items = frame([{"item_id": 1, "text": "brown fox jumps over the lazy"}], "item_id long, text string")
    assert native(external_shuffle(odd, 4)) and native(contained_items(odd, items))


# 4: decontamination

def test_containment_edges(spark, odd, none, frame):
    fox = "quick brown fox jumps over the lazy dog"
    items = frame([
        {"item_id": 1, "text": "Quick, brown FOX jumps over the lazy dog!"}, {"item_id": 2, "text": "brown fox jumps"},
        {"item_id": 3, "text": None}, {"item_id": 4, "text": ""}, {"item_id": None, "text": fox},
        {"item_id": 5, "text": fox + " one two three four five six seven eight"}, {"item_id": 6, "text": fox}, {"item_id": 6, "text": fox},
        {"item_id": 7, "text": "lorem ipsum dolor lorem ipsum dolor lorem ipsum dolor"}, {"item_id": 6, "text": "other words under that id"},
        {"item_id": 8, "text": "brun saute"}, {"item_id": 9, "text": "saute brun"}, {"item_id": 10, "text": "..."},
    ], "item_id long, text string")
    docs = odd.withColumn("item", F.lit(1))
    whole = [(i, j, 4, 4, 1.0) for i in (1, 2) for j in (1, 6, None)] + [(6, 7, 3, 3, 1.0)]
    short = [(1, 2, 1, 1, 1.0), (2, 2, 1, 1, 1.0), (None, 8, 1, 1, 1.0)]
    for limit in (1 << 25, 0):
        got = Counter(tuple(r) for r in contained_items(docs, items, broadcast_bytes=limit).collect())
        assert got == Counter(whole + short)
    assert contained_items(none, items).collect() == [] and contained_items(docs, items.filter("false")).collect() == []


def test_search_loses_no_item_at_any_damage(frame):
    """Items of many sizes with words replaced: found exactly when enough shingles are left."""
    rng = np.random.default_rng(3)
    vocabulary = [f"word{k}" for k in range(4000)]
    items, docs, k = [], [], 0
    for size in (5, 6, 9, 12, 20, 37, 64, 90):
        for broken in range(4):
            words = rng.choice(vocabulary, size).tolist()
            items.append({"item_id": k, "text": " ".join(words)})
            for at in rng.choice(size, min(broken, size), replace=False):
                words[at] = "broken"
            around = rng.choice(vocabulary, 400).tolist()
            docs.append({"doc_id": k, "text": " ".join(around[:200] + words + around[200:])})
            k += 1
    def shingles(text):
        w = text.split()
        return {tuple(w[i:i + 5]) for i in range(len(w) - 4)}
    wanted = {(d["doc_id"], i["item_id"]) for d in docs for i in items
              if len(shingles(i["text"]) & shingles(d["text"])) >= 0.8 * len(shingles(i["text"])) - 1e-9}
    found = contained_items(frame(docs, "doc_id long, text string"), frame(items, "item_id long, text string"))
    assert {(r["doc_id"], r["item_id"]) for r in found.collect()} == wanted and len(wanted) > 8


# 5 and 6: packing and token files

def encoded(name, end, rows):
    whole = Tokenizer.from_file(public_tokenizers.path(name))
    return [(i, np.array([*whole.encode(t or "", add_special_tokens=False).ids, end], dtype="<u4")) for i, t in rows]


@pytest.mark.parametrize("longest", [64, 2048])
def test_packed_pieces_hold_every_id_once(spark, odd, none, tmp_path, longest):
    pieces = pack(odd, longest)
    rows = pieces.collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    want = Counter()
    for i, ids in encoded("byte_bpe_50k.json", 1, [(i, t) for i, t, _ in ODD]):
        at = 0
        for length in [longest] * (len(ids) // longest) + [1 << b for b in range(12, -1, -1) if len(ids) % longest >> b & 1]:
            want[(i, at, length, len(ids), ids[at:at + length].tobytes())] += 1
            at += length
    assert Counter((r["doc_id"], r["start"], r["length"], r["doc_tokens"], bytes(r["ids"])) for r in rows) == want
    assert all(r["offset"] == 0 and 1 << r["bucket"] == r["length"] for r in rows)
    write_buckets(pieces, str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == len(rows)
    assert piece_digests(none).collect() == []
    with pytest.raises(ValueError):
        pack(odd, 1000)


def test_token_file_round_trip(spark, odd, none):
    rows = [(r[0], r[1]) for r in odd.select("doc_id", "text").collect()]
    for block in (1, 1 << 20):
        got = sorted(token_digests(odd, block_tokens=block).collect(), key=lambda r: r["start"])
        ids = [r["doc_id"] for r in got]
        assert ids == sorted(ids, key=lambda i: (i is not None, i))
        at = 0
        for r in got:
            assert r["start"] == at
            at += r["n_tokens"]
        assert Counter((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got) == Counter(
            (i, len(x), zlib.crc32(x.tobytes())) for i, x in encoded("word_bpe_49k.json", 2, rows))
    assert token_digests(none).collect() == []


# 7: vectors

def vector_rows():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 6))
    near = [c + rng.normal(scale=s, size=6) for c in centres for s in (0.0, 0.0, 0.05, 0.15, 0.3, 0.3)]
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(near)]
    rows += [(100, None), (101, []), (102, [0.0] * 6), (103, [1.0, None] + [0.0] * 4), (104, [float("nan")] * 6),
             (105, [float("inf")] + [0.0] * 5), (106, [1.0, 0.0]), (107, [2.0, 0.0]), (0, rows[0][1]), (108, [1e200] * 6), (109, [1e-200] * 6)]
    return rows


@pytest.mark.parametrize("rows_per_cell,chunk", [(8192, 8192), (4, 3), (10, 1000)])
def test_vectors_equal_brute_force(frame, rows_per_cell, chunk):
    rows = vector_rows()
    vectors = frame([{"vec_id": i, "embedding": v, "size": 3, "label": None} for i, v in rows],
                    "vec_id long, embedding array<double>, size int, label int")
    unit = []
    for _, v in rows:
        ok = bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)
        scaled = np.array(v) / max(map(abs, v)) if ok else None
        unit.append(scaled / np.linalg.norm(scaled) if ok else None)
    n = len(rows)
    links = [[a != b and unit[a] is not None and unit[b] is not None and len(unit[a]) == len(unit[b])
              and float(unit[a] @ unit[b]) >= 0.95 for b in range(n)] for a in range(n)]
    group = list(range(n))
    for a in range(n):
        for b in range(n):
            if links[a][b] and group[a] != group[b]:
                old = group[b]
                group = [group[a] if g == old else g for g in group]
    low = [min(rows[b][0] for b in range(n) if group[b] == group[a]) for a in range(n)]
    want = Counter((rows[a][0], sum(links[a]), low[a], rows[a][0] == low[a]) for a in range(n))
    got = vector_components(vectors, rows_per_cell=rows_per_cell, chunk=chunk).collect()
    assert Counter(tuple(r) for r in got) == want
    assert vector_components(vectors.filter("false")).collect() == []


# 8 and 9: classifiers

@pytest.fixture
def mixed(frame):
    rows = []
    for k in range(200):
        lang, words = [("aa", "kapo lumi tola veka"), ("bb", "schwer zwischt nicht uber")][k % 2]
        rows.append({"doc_id": k, "lang": lang, "text": f"{words} {words.split()[k % 4]}" + (" vile" if k % 5 == 0 else "")})
    return frame(rows, "doc_id long, text string, lang string, score double, predicted int")


def test_languages(mixed, odd, none):
    rows = {r["doc_id"]: r for r in identify_languages(mixed).collect()}
    assert len(rows) == 200 and all(r["lang_pred"] == ("aa", "bb")[i % 2] and not r["rejected"] for i, r in rows.items())
    assert all(r["held_out"] == (zlib.crc32(str(i).encode()) % 5 == 0) for i, r in rows.items())
    strange = identify_languages(odd).collect()
    assert len(strange) == len(ODD)
    assert Counter(r["lang_pred"] == "und" for r in strange)[True] == 5
    assert identify_languages(none).collect() == []
    assert {r["lang_pred"] for r in predict_languages(odd, None).collect()} == {"und"}


def test_toxicity(frame, mixed, odd, none):
    labels = frame([{"doc_id": k, "toxic": int(k % 5 == 0), "score": 9.0} for k in range(150)] + [
        {"doc_id": None, "toxic": 1}, {"doc_id": 3, "toxic": None}, {"doc_id": 10, "toxic": 1}, {"doc_id": 999, "toxic": 1}],
        "doc_id long, toxic int, score double")
    rows = {r["doc_id"]: r for r in classify_toxicity(mixed, labels).collect()}
    assert len(rows) == 200 and all(r["predicted"] == int(i % 5 == 0) and 0 <= r["score"] <= 1 for i, r in rows.items())
    assert len(classify_toxicity(odd, labels).collect()) == len(ODD)
    assert classify_toxicity(none, labels).collect() == []
    assert {r["score"] for r in classify_toxicity(mixed, labels.filter("toxic = 0")).collect()} == {0.0}


# 10: SimHash

@pytest.mark.parametrize("source", ["odd", "documents", "none"])
def test_simhash_equals_brute_force(spark, odd, none, source):
    if source == "documents" and not os.path.isdir(SF):
        pytest.skip("driver tables are not here")
    docs = {"odd": odd, "none": none}.get(source) or table(spark, "documents")
    rows = [(r[0], fingerprint(r[1], 3)) for r in docs.select("doc_id", "text").collect()]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (rows[a][1] ^ rows[b][1]).bit_count() <= 3 and group[a] != group[b]:
                old = group[a]
                group = [group[b] if g == old else g for g in group]
    def low(a):
        return min((rows[b][0] for b in range(len(rows)) if group[b] == group[a] and rows[b][0] is not None), default=None)
    want = Counter((rows[a][0], f"{rows[a][1]:016x}", low(a)) for a in range(len(rows)))
    assert Counter(tuple(r) for r in simhash_components(docs).collect()) == want


def test_large_buckets_are_cut_without_loss(spark):
    from placeledger.llm.simhash import links
    from placeledger.operators.identity import connected_components

    rng = np.random.default_rng(9)
    base = int(rng.integers(0, 1 << 62))
    codes = sorted({base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 63, (300, 2))} | {int(x) for x in rng.integers(0, 1 << 62, 200)})
    frame = spark.createDataFrame([(c,) for c in codes], "fp long")
    group = {c: c for c in codes}
    for a in codes:
        for b in codes:
            if a < b and (a ^ b).bit_count() <= 3 and group[a] != group[b]:
                low, old = min(group[a], group[b]), max(group[a], group[b])
                group = {c: low if g == old else g for c, g in group.items()}
    for chunk in (20, 8192):
        named = dict(tuple(r) for r in connected_components(links(frame, chunk=chunk)).collect())
        assert {c: named.get(c, c) for c in codes} == group


# The pipeline

def docs_like(frame, rows):
    kinds = "doc_id long, text string, lang string, source string, n_chars long, _key int, _copy string, row int, key map<string,int>"
    return frame([{"doc_id": i, "text": t, "lang": g, "_key": 5, "_copy": "c"} for i, t, g in rows], kinds)


@given_tables
def test_stages_take_odd_rows_and_empty_tables(spark, frame):
    docs = docs_like(frame, ODD)
    for rows in (docs, docs.filter("false")):
        for name, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, rows, SF)
            assert out.schema.simpleString() == docs.schema.simpleString(), name
            assert out.count() <= len(ODD)
    out = corpus_pipeline.distinct_texts(spark, docs, SF).collect()
    assert {(r["_key"], r["_copy"]) for r in out} == {(5, "c")}
    kept = [(r["doc_id"], r["text"]) for r in out]
    assert Counter(kept) == Counter([(1, ODD[0][1]), (1, ODD[-1][1]), (3, ""), (None, ODD[6][1]), (6, LONG), (7, "123 456"), (8, "x")])
    assert corpus_pipeline.known_language(spark, docs, SF).filter("text IS NULL OR trim(text) = ''").count() == 0


def edited(rng, words, changes):
    for _ in range(changes):
        words = [*words]
        words[rng.integers(len(words))] = f"e{rng.integers(1 << 40)}"
    return words


def test_near_duplicates_are_judged_by_their_texts(spark, frame):
    """Copies that lie beyond the radius go; texts within it that are no copies stay."""
    rng = np.random.default_rng(3)
    far, close = [], []
    while not (far and close):
        words = [f"w{k}" for k in rng.integers(0, 1 << 30, 120)]
        other = edited(rng, words, int(rng.integers(2, 7)))
        a, b = " ".join(words), " ".join(other)
        shared = len(np.intersect1d(shingle_set(a), shingle_set(b))) / len(np.union1d(shingle_set(a), shingle_set(b)))
        bits = (fingerprint(a, 3) ^ fingerprint(b, 3)).bit_count()
        if shared >= 0.85 and bits > corpus_pipeline.RADIUS:
            far = [a, b]
        elif shared < 0.79 and bits <= corpus_pipeline.RADIUS:
            close = [a, b]
    docs = docs_like(frame, [(k, t, "en") for k, t in enumerate([*far, *close])])
    assert sorted(r["doc_id"] for r in corpus_pipeline.distinct_texts(spark, docs, SF).collect()) == [0, 2, 3]


@pytest.mark.parametrize("tile", [600, 1 << 20])
def test_first_copies_equal_brute_force(frame, tile):
    rng = np.random.default_rng(4)
    base = [[f"w{k}" for k in rng.integers(0, 1 << 30, 80)] for _ in range(6)]
    texts = [" ".join(edited(rng, base[k % 6], int(rng.integers(0, 2)))) for k in range(60)]
    texts += ["", " ", "One two", "one TWO", "one", "one"]
    sets = [shingle_set(t) for t in texts]
    first = similar_groups(sets, 0.8)
    first[texts.index(" ")] = texts.index("")
    docs = frame([{"doc_id": k, "text": t} for k, t in enumerate(texts)], "doc_id long, text string")
    assert sorted(r[0] for r in first_copies(docs, 6, tile=tile).collect()) == sorted(set(first.tolist()))


@given_tables
def test_pipeline_equals_the_operators(spark):
    """Each stage's rows follow from its operator's own result on the stage before."""
    docs = table(spark, "documents")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, stage(spark, docs, SF)
        out[name] = (before, docs)

    def ids(df):
        return sorted(r[0] for r in df.select("doc_id").collect())

    before, after = out["language_id"]
    assert ids(after) == ids(identify_languages(before).filter("NOT rejected"))
    before, after = out["toxicity"]
    assert ids(after) == ids(classify_toxicity(before, table(spark, "labels")).filter("predicted = 0"))
    before, after = out["near_duplicates"]
    rows = sorted((r["doc_id"], r["text"]) for r in before.collect())
    sets = [set(shingle_set(t).tolist()) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            near = len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9
            if near and group[a] != group[b]:
                low, high = sorted((group[a], group[b]))
                group = [low if g == high else g for g in group]
    assert ids(after) == sorted(rows[g][0] for g in set(group)) and len(set(group)) < len(rows)
    before, after = out["decontamination"]
    held = ids(contained_items(before, table(spark, "benchmark")))
    assert ids(after) == sorted(set(ids(before)) - set(held)) and held
    before, after = out["packing"]
    assert sorted(set(ids(after))) == ids(before)
    run = corpus_pipeline.run(spark, SF)
    key = ["doc_id", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, run.select(key).collect())) == sorted(map(tuple, after.select(key).collect()))
