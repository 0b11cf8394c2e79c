"""Classifiers against naive loops over windows, sets and words; row handling of exact
dedup, memory bounds of the trie and of the segment memo."""

import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from runlens.llm import exact_dedup, language_id, lm_score, quality_cnn, sentencepiece_codec, shards, toxicity_cnn


def laid(texts):
    return np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)


def random_texts(seed, alphabet, sizes):
    r = random.Random(seed)
    return ["".join(r.choice(alphabet) for _ in range(n)).encode() for n in sizes]


SIZES = [0, 1, 7, 255, 256, 257, 0, 600, 1500, 64, 3]


def naive_quality(text, model):
    starts = range(0, max(1, len(text)), quality_cnn.CHUNK)
    chunks, filled = [], []
    for at in starts:
        filled.append(max(1, min(quality_cnn.CHUNK, len(text) - at)))
        best = np.zeros(quality_cnn.FILTERS)
        for window in range(at, at + filled[-1], quality_cnn.STRIDE):
            response = np.zeros(quality_cnn.FILTERS)
            for k in range(quality_cnn.WIDTH):
                response += model["table"][k][text[window + k] if window + k < len(text) else 0]
            best = np.maximum(best, response)
        chunks.append(best)
    features = np.concatenate([np.max(chunks, axis=0), np.average(chunks, axis=0, weights=filled)])
    return 1 / (1 + math.exp(-(features @ model["weights"] + model["bias"][0])))


def test_quality_equals_a_loop_over_windows():
    rng = np.random.default_rng(1)
    model = {"table": rng.normal(0, 0.3, (quality_cnn.WIDTH, 256, quality_cnn.FILTERS)).astype(np.float32),
             "weights": rng.normal(0, 0.1, 2 * quality_cnn.FILTERS).astype(np.float32), "bias": np.array([0.2], np.float32)}
    texts = random_texts(2, "abc é漢", SIZES)
    got = quality_cnn.probabilities(*laid(texts), model)
    assert np.allclose(got, [naive_quality(t, model) for t in texts], atol=1e-4)


def naive_bucket(gram):
    key, mask = int.from_bytes(gram, "big"), 0xFFFFFFFF
    h = (key + len(gram) * 0x3C6EF372) * 0x9E3779B1 & mask
    return ((h ^ h >> 15) * 0x85EBCA77 & mask) >> 16


def gram_set(text):
    low = bytes(b + 32 if 65 <= b <= 90 else b for b in text)
    return {naive_bucket(low[i:i + n]) for n in language_id.ORDERS for i in range(len(low) - n + 1)}


def kernel(a, b):
    return len(a & b) / math.sqrt(max(1, len(a)) * max(1, len(b)))


def test_language_equals_kernel_ridge_on_sets():
    train = [t for i in range(3) for t in random_texts(i, ("abcde ", "efghi ", "ijkab ")[i], range(20, 32))]
    langs, names = [x for x in "abc" for _ in range(12)], ["a", "b", "c"]
    model = language_id.train_machines(train, langs, names, landmarks=15)
    # landmarks: the first five of each language
    sets = [gram_set(t) for t in train]
    marks = [sets[12 * k + j] for j in range(5) for k in range(3)]
    value, basis = np.linalg.eigh(np.array([[kernel(a, b) for b in marks] for a in marks]))
    root = basis / np.sqrt(np.maximum(value, 1e-6)) @ basis.T
    phi = np.array([[kernel(a, b) for b in marks] for a in sets]) @ root
    target = np.where(np.array(langs)[:, None] == np.array(names), 1.0, -1.0)
    weights = np.linalg.solve(phi.T @ phi + language_id.RIDGE * np.eye(15), phi.T @ target)
    texts = random_texts(9, "abcdefghijk ABC", SIZES)
    want = np.array([[kernel(gram_set(t), b) for b in marks] for t in texts]) @ root @ weights
    best, output = language_id.predict(*laid(texts), model)
    assert np.allclose(output, want.max(axis=1), atol=1e-3)
    clear = np.sort(want, axis=1)[:, -1] - np.sort(want, axis=1)[:, -2] > 1e-3
    assert clear.sum() >= 7 and (best[clear] == want.argmax(axis=1)[clear]).all()


def naive_row(word, size):
    mask, h, power = (1 << 64) - 1, 0, 1
    for b in word.lower():
        power = power * int(toxicity_cnn._P) & mask
        h = h + (b + 1) * power & mask
    h = (h ^ h >> 29) * int(toxicity_cnn._M) & mask
    return (h ^ h >> 32) % size


def naive_toxicity(text, model):
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", text)
    rows = [naive_row(w, toxicity_cnn.WORD_ROWS) for w in words]
    vectors = [model["word"][r] + model["prefix"][naive_row(w[:toxicity_cnn.PREFIX], toxicity_cnn.PREFIX_ROWS)]
               for w, r in zip(words, rows)]
    features = []
    for width in toxicity_cnn.WIDTHS:
        best = np.full(toxicity_cnn.FILTERS, -np.inf)
        for at in range(len(words)):
            seen = sum(vectors[at + k] @ model[f"filter{width}"][k] for k in range(width) if at + k < len(words))
            best = np.maximum(best, seen)
        features.append(np.maximum(best + model[f"shift{width}"], 0) if words else np.zeros(toxicity_cnn.FILTERS))
    z = np.concatenate(features) @ model["weights"] + model["bias"][0]
    guess = model["names"][int(np.argmax(sum(model["rates"][r] for r in rows)))] if words else toxicity_cnn.ALL
    cut = model["thresholds"].get(guess, model["thresholds"][toxicity_cnn.ALL])
    odds = math.log(toxicity_cnn.CUT / (1 - toxicity_cnn.CUT))
    return 1 / (1 + math.exp(-(z - cut + odds)))


def test_toxicity_equals_a_loop_over_words():
    rng = np.random.default_rng(4)
    small = lambda *shape: rng.normal(0, 0.5, shape).astype(np.float32)
    f = toxicity_cnn.FILTERS
    model = {"word": small(toxicity_cnn.WORD_ROWS, toxicity_cnn.DIM), "prefix": small(toxicity_cnn.PREFIX_ROWS, toxicity_cnn.DIM),
             "weights": small(f * len(toxicity_cnn.WIDTHS)), "bias": small(1), "names": ["de", "en"],
             "rates": small(toxicity_cnn.WORD_ROWS, 2), "thresholds": {toxicity_cnn.ALL: 0.3, "en": -0.4}}
    for width in toxicity_cnn.WIDTHS:
        model[f"filter{width}"], model[f"shift{width}"] = small(width, toxicity_cnn.DIM, f), small(f)
    texts = random_texts(5, "aBcd9 -.é", SIZES) + [b"one", b"... !", b"two words", b"x" * 300 + b" y"]
    got = toxicity_cnn.probabilities(*laid(texts), model)
    assert np.allclose(got, [naive_toxicity(t, model) for t in texts], atol=1e-4)


def test_toxicity_learns_from_every_labelled_row(docs, spark, monkeypatch):
    """A language and the words of it in few of many rows, those that come last by the
    hash of their id; the texts dealt to several shards."""
    ids = [r.i for r in spark.range(16000).selectExpr("id AS i").orderBy(F.xxhash64("i"), "i").collect()
           if zlib.crc32(str(r.i).encode()) % 3 != 1]
    last = set(ids[-160:])
    table = [(i, f"zz zum {'grob' if i % 2 else 'fein'} zz", "zz") if i in last
             else (i, f"the {'nasty' if i % 2 else 'plain'} word {i % 7}", "en") for i in ids]
    frame = docs(table)
    known = spark.createDataFrame([(i, i % 2) for i in ids], "doc_id long, toxic int")
    monkeypatch.setattr(toxicity_cnn, "SHARD_BYTES", 60_000, raising=False)
    model = toxicity_cnn.train_toxicity(frame, known)
    assert model["names"] == ["en", "zz"] and set(model["thresholds"]) == {"*", "en", "zz"}
    out = {r.doc_id: r.predicted for r in toxicity_cnn.score_toxicity(frame, model).collect()}
    assert all(out[i] == i % 2 for i in ids)


def test_chunks_of_shards():
    rows = [(1, 5), (1, 5), (1, 9), (2, 0), (3, 0), (3, 50), (3, 1)]
    batches = [pa.RecordBatch.from_pylist([{"shard": s, "size": n} for s, n in part])
               for part in (rows[:2], [], rows[2:5], rows[5:]) if part]
    got = [[(r["shard"], r["size"]) for r in t.to_pylist()] for t in shards.chunks(iter(batches), "shard", "size", 12)]
    assert got == [rows[:2], rows[2:3], rows[3:4], rows[4:6], rows[6:]]
    assert list(shards.chunks(iter([]), "shard", "size", 12)) == []


def test_best_threshold_of_counts():
    rng = np.random.default_rng(3)
    for _ in range(50):
        values = np.arange(rng.integers(1, 9)) * 0.5
        counts = rng.integers(0, 4, (2, len(values)))
        z, y = (np.concatenate([np.repeat(values, c) if k else np.full(c.sum(), i)
                                for i, c in enumerate(counts)]) for k in (1, 0))

        def good(cut):
            return (z[y == 0] < cut).sum() / max(1, (y == 0).sum()) - (z[y == 1] < cut).sum() / max(1, (y == 1).sum())
        cuts = [values[0] - 1, *(values[1:] + values[:-1]) / 2, values[-1] + 1]
        best = [c for c in cuts if good(c) >= max(map(good, cuts)) - 1e-12]
        assert toxicity_cnn.best_threshold(values, counts) == pytest.approx((best[0] + best[-1]) / 2)


def test_exact_dedup_keeps_one_length_of_an_id(docs):
    table = docs([(1, "ab"), (1, "a  b"), (2, "ab"), (None, "c"), (None, " c "), (3, None), (3, "")])
    got = {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in exact_dedup.exact_dedup(table).collect()}
    assert got == {(1, 1, 3, True), (1, 1, 3, False), (2, 1, 3, False), (None, None, 2, True), (None, None, 2, False),
                   (3, 3, 2, True)}
    kept = sorted((r.text or "") for r in corpus_pipeline.exact(table.sparkSession, table, "").collect())
    assert kept == ["", " c ", "a  b"]


def test_trie_size_counts_nodes():
    trie = exact_dedup.PatriciaTrie()
    for word in (b"team", b"tea", b"toast", b"tea"):
        trie.insert(word, (0, False, 1))

    def nodes(node):
        return 1 + sum(map(nodes, node[1].values()))

    def labels(node):
        return len(node[0]) + sum(map(labels, node[1].values()))
    assert trie.size == (nodes(trie.root) - 1) * exact_dedup.NODE_BYTES + labels(trie.root)
    list(trie.spill())
    assert trie.size == 0 and not trie.root[1]


def test_segment_memo_is_bounded_by_bytes():
    path = str(public_tokenizers.path("piece_bpe_32k.model"))
    small = sentencepiece_codec.PrefixTableCodec(path, memo_bytes=40_000)
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    r = random.Random(3)
    for n in range(300):
        text = " ".join("".join(r.choice("abcdeé漢") for _ in range(r.choice([1, 4, 9, 700]))) for _ in range(5))
        parts = small.encode_parts(text)
        assert [int(i) for part in parts for i in part.split()] == library.encode(text)
        assert small.decode_parts(parts) == library.decode(library.encode(text))
        assert small.held <= 40_000 and len(small.ids_text) * sentencepiece_codec.ENTRY_BYTES <= small.held
    assert max(map(len, small.ids_text)) < 700


def test_rows_without_id_spread_over_blocks(docs, monkeypatch):
    """Scores do not depend on how rows without an id are dealt."""
    table = docs([(None, f"some text {i}") for i in range(40)] + [(None, None)])
    whole = sorted((r.base_score, round(r.score, 9)) for r in lm_score.score_documents(table).collect())
    monkeypatch.setattr(lm_score, "BLOCK_BYTES", 50)
    assert sorted((r.base_score, round(r.score, 9)) for r in lm_score.score_documents(table).collect()) == whole
