"""Token output, whitening and spelling variants: against the library, numpy and brute
force, with odd rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from runlens.llm import (byte_bpe, eigen, minhash, quality_cnn, repair, sampling, spelling, token_output,
                         toxicity_cnn, whitening)
from runlens.llm.queries import vocabulary

from .conftest import ODD

VOCAB = "byte_bpe_50k.json"


# -- byte-level BPE


def library():
    from tokenizers import Tokenizer
    return Tokenizer.from_file(public_tokenizers.path(VOCAB))


LONG = ["a" + " " * 1_000_000 + "b", " " * 20_000, "a" + " " * 20_000 + "\n" * 9 + "<|endoftext|>  x", "　" * 12_000 + "é",
        "漢 a  b\t\t" * 200_000, "x" * 300_000, "  a <|endoftext|> <|endoftext|>b  "]


@pytest.mark.parametrize("k", range(len(LONG)))
def test_long_runs_of_blanks_have_the_librarys_ids(k):
    want = library().encode(LONG[k], add_special_tokens=False).ids
    bpe = byte_bpe.byte_bpe(vocabulary(VOCAB))
    assert bpe.encode(LONG[k]) == want
    assert bpe.array(LONG[k], 2).tolist() == [*want, 2]


def test_random_texts_have_the_librarys_ids():
    lib, bpe, rng = library(), byte_bpe.byte_bpe(vocabulary(VOCAB)), random.Random(5)
    for _ in range(3000):
        text = "".join(rng.choice("ab'st  \n\t\x85\xa0\x1c01²½ªßÀ×.,!é_-漢") for _ in range(rng.randrange(30)))
        assert bpe.encode(text) == lib.encode(text, add_special_tokens=False).ids


# -- Re-Pair


@pytest.mark.parametrize("ids", [[], [5], [7] * 5000, [1, 2] * 3000 + [1], list(range(3000)), [70000, 1] * 900,
                                 [3, 3, 3, 4] * 800 + [9] * 3])
def test_repair_round_trip(ids):
    ids = np.array(ids, dtype=np.uint32)
    data = repair.Encoded(repair.encode(ids, 2))
    assert np.array_equal(data.ids(), ids)
    rng = random.Random(1)
    for _ in range(30):
        a, b = sorted((rng.randint(0, len(ids)), rng.randint(0, len(ids))))
        assert np.array_equal(data.range(a, b), ids[a:b])
    with pytest.raises(IndexError):
        data.range(0, len(ids) + 1)


def test_repair_random_sequences_and_size():
    rng = np.random.default_rng(4)
    for _ in range(200):
        ids = rng.integers(0, rng.integers(1, 8), rng.integers(0, 3000)).astype(np.uint32)
        assert np.array_equal(repair.Encoded(repair.encode(ids, 2)).ids(), ids)
    text = np.tile(rng.integers(0, 50_000, 500), 200).astype(np.uint32)
    assert len(repair.encode(text)) < len(text) * 4 / 50


def test_repair_rules_hold_smaller_symbols():
    seq, rules, terminals = repair.compress(np.array([1, 2, 3] * 500, dtype=np.uint32), 2)
    n = len(terminals)
    assert len(rules) and (rules < n + np.arange(len(rules))[:, None]).all()
    assert (repair.expansion_lengths(rules, n) >= 2).all() and len(seq) < 10


# -- token output


def expected_output(table):
    """(doc_id, n_tokens, crc) per document, by the library."""
    lib = library()
    out = []
    for row in table:
        ids = np.array([*lib.encode(row[1] or "", add_special_tokens=False).ids, 2], dtype="<u4")
        out.append((row[0], len(ids), zlib.crc32(ids)))
    return out


@pytest.mark.parametrize("piece, shard, of_range", [(1 << 18, 1 << 20, 1 << 22), (700, 2_000, 5_000)])
def test_token_output_of_odd_rows(docs, tmp_path, monkeypatch, piece, shard, of_range):
    """NULL and empty texts, repeated ids and rows, a long text in many pieces; ranges
    and shards of all sizes hold the same documents in ascending order."""
    monkeypatch.setattr(token_output, "PIECE_IDS", piece)
    table = ODD + [(7, "w " * 3000)] + [(9, "same text")] * 40
    path = str(tmp_path / "shards")
    token_output.write_shards(docs(table), vocabulary(VOCAB), path, shard_ids=shard, range_ids=of_range)
    shards = token_output.read_shards(docs(table).sparkSession, path)
    got = sorted((tuple(r) for r in token_output.read_documents(shards).collect()), key=lambda r: r[1])
    assert Counter((r[0], r[2], r[3]) for r in got) == Counter(expected_output(table))
    order = [(r[0] is not None, r[0] or 0) for r in got]
    assert order == sorted(order)
    starts = np.cumsum([0] + [r[2] for r in got])
    assert [r[1] for r in got] == starts[:-1].tolist()
    if piece == 700:
        assert shards.count() > 10 and shards.select("range").distinct().count() > 1


def test_token_output_fetches_named_documents(docs, tmp_path):
    path = str(tmp_path / "shards")
    token_output.write_shards(docs(ODD), vocabulary(VOCAB), path, shard_ids=100, range_ids=100_000)
    shards = token_output.read_shards(docs(ODD).sparkSession, path)
    got = {r.doc_id: r.tokens for r in token_output.fetch_ids(shards, [6, 7, 99]).collect()}
    lib = library()
    assert got == {i: [*lib.encode(t, add_special_tokens=False).ids, 2] for i, t in ODD if i in (6, 7)}


def test_token_output_of_an_empty_table(docs):
    out = token_output.token_output(docs([]), vocabulary(VOCAB))
    assert out.columns == ["doc_id", "start", "n_tokens", "ids_crc32"] and out.count() == 0


def test_token_output_with_clashing_columns(spark):
    names = ["id", "crc", "row", "piece", "pieces", "before", "n", "width", "tokens", "range", "shard", "start", "n_tokens"]
    df = spark.createDataFrame([(4, "a b") + (None,) * len(names)],
                               "doc_id long, text string, " + ", ".join(f"{n} int" for n in names))
    assert [tuple(r)[:3] for r in token_output.token_output(df, vocabulary(VOCAB)).collect()] == [(4, 0, 3)]


# -- rows that share an id, columns that clash


LONG_A, LONG_B = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")


def test_minhash_keeps_links_of_an_id_with_two_texts(docs):
    table = [(1, LONG_A), (1, LONG_B), (2, LONG_A + " x"), (3, LONG_B + " y"), (4, "one two"), (1, None), (1, LONG_A)]
    got = {(r.doc_id, r.n_shingles): (r.component_id, r.kept) for r in minhash.near_duplicates(docs(table)).collect()}
    assert got == {(1, 56): (1, True), (2, 57): (1, False), (3, 57): (1, False), (4, 1): (4, True), (1, 0): (1, True)}


def test_pipeline_stages_judge_rows_not_ids(spark):
    stages = dict(corpus_pipeline.STAGES)
    names = ["class", "__sid", "keep_id", "__keep", "__sha", "sha", "row", "hash", "id", "component", "points", "owner"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)

    def kept(stage, rows):
        df = spark.createDataFrame([(i, t, "en", "s", 0, *names) for i, t in rows], schema)
        out = stages[stage](spark, df, "")
        assert out.columns == df.columns
        got = out.collect()
        assert all(tuple(r)[5:] == tuple(names) for r in got)
        return sorted(((r.doc_id, r.text) for r in got), key=repr)

    near = "MinHash near-dedup"
    assert kept(near, [(0, LONG_A), (1, LONG_A), (1, LONG_B)]) == [(0, LONG_A), (1, LONG_B)]
    assert kept(near, [(None, LONG_A), (5, LONG_A + " x"), (6, LONG_A), (7, ""), (8, None)]) == [
        (5, LONG_A + " x"), (7, ""), (8, None), (None, LONG_A)]
    exact = "exact dedup"
    assert kept(exact, [(1, "ab"), (1, "a  b"), (2, "a b"), (3, None), (4, " ")]) == [(1, "a  b"), (4, " ")]
    assert kept(exact, [(1, "ab"), (1, "ab"), (None, "ab")]) in ([(1, "ab")], [(None, "ab")])


@pytest.mark.parametrize("train", [quality_cnn.train_quality, toxicity_cnn.train_toxicity])
def test_classifiers_train_on_tables_with_clashing_columns(spark, train):
    rows = [(k, f"{'good fine' if k % 2 else 'bad awful'} text {k}", "en", "x", "y", "z", 1) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, class string, __sid string, __x0 string, _row int")
    marks = spark.createDataFrame([(k, k % 2, k % 2) for k in range(60)], "doc_id long, quality int, toxic int")
    assert train(df, marks.unionByName(marks)) is not None


def test_samples_bound_rows_and_bytes(spark, monkeypatch):
    rows = [(1, f"text {k}") for k in range(50)] + [(2, "x" * 5000), (3, "short"), (4, "other")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    classes = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 4, 1)], "doc_id long, class int")
    assert sampling.sample_texts(df, classes, [0, 1], 10).groupBy("class").count().collect() != []
    assert max(r["count"] for r in sampling.sample_texts(df, classes, [0, 1], 10).groupBy("class").count().collect()) <= 10
    monkeypatch.setattr(sampling, "SAMPLE_BYTES", 1000)
    assert "x" * 5000 not in {r.text for r in sampling.sample_texts(df, classes, [0, 1], 100).collect()}


# -- eigenpairs and whitening


@pytest.mark.parametrize("kind", ["random", "identity", "two values", "low rank", "zero", "one"])
def test_leading_pairs(kind):
    rng = np.random.default_rng(2)
    a = rng.standard_normal((40, 90)) * np.linspace(1, 4, 40)[:, None]
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    matrix = {"random": a @ a.T, "identity": np.eye(40) * 3, "two values": q @ np.diag([5.0] * 25 + [1.0] * 15) @ q.T,
              "low rank": a[:, :6] @ a[:, :6].T, "zero": np.zeros((40, 40)), "one": np.array([[2.5]])}[kind]
    matrix = (matrix + matrix.T) / 2
    values, axes = eigen.leading_pairs(matrix, 32)
    want = np.linalg.eigvalsh(matrix)[::-1][:32]
    size = np.abs(want).max() or 1
    assert np.abs(values - want).max() <= 1e-13 * size
    assert np.abs(matrix @ axes - axes * values).max() <= 1e-13 * size
    assert np.abs(axes.T @ axes - np.eye(len(values))).max() < 1e-12


def naive_whitening(vectors, components):
    x = np.array([[int(np.floor(64 * c)) + 1_000_000 for c in v] for v in vectors])
    n, sums = len(x), x.sum(axis=0)
    y = np.array([[int(n * a - s) for a, s in zip(row, sums)] for row in x], dtype=object)
    covariance = ((y.T @ y) / (n * n)).astype(float) / n
    values, axes = np.linalg.eigh(covariance)
    values, axes = values[::-1][:components], axes[:, ::-1][:, :components]
    z = (y / n).astype(float) @ axes / np.sqrt(values)
    return n, [int(v) for v in (y ** 2).sum(axis=1)], z, values / np.trace(covariance)


def vector_table(spark, rows):
    """Vectors under the names of internal columns beside them."""
    return spark.createDataFrame([(i, v, 1, 2, 3, 4) for i, v in rows],
                                 "vec_id long, embedding array<float>, id int, v int, n int, component int")


def test_whitening_equals_numpy(spark):
    rng = np.random.default_rng(6)
    v = (rng.standard_normal((300, 12)) * np.linspace(1, 5, 12)).astype(np.float32)
    odd = [(900, None), (901, [1.0] * 11 + [None]), (902, [float("nan")] + [0.0] * 11), (903, [float("inf")] + [0.0] * 11),
           (904, [1.0, 2.0]), (905, [])]
    rows = [(int(i), v[i].tolist()) for i in range(300)] + [(7, v[7].tolist()), (None, v[8].tolist())]
    got = whitening.whiten(vector_table(spark, rows + odd), components=5).collect()
    n, deviation, z, explained = naive_whitening([r[1] for r in rows], 5)
    assert len(got) == 5 * len(rows) and {r.n for r in got} == {n} and {r.vec_id for r in got} == {r[0] for r in rows}
    assert {r.identity_error for r in got} == {got[0].identity_error} and got[0].identity_error < 1e-12
    by = {(r.vec_id, r.component): r for r in got}
    for c in range(5):
        sign = np.sign(by[0, c + 1].whitened * z[0, c])
        for k in range(300):
            r = by[k, c + 1]
            assert int(r.deviation) == deviation[k] and abs(r.whitened * sign - z[k, c]) < 1e-10
            assert abs(r.explained - explained[c]) < 1e-12


def test_whitening_is_exact_far_from_zero(spark):
    rows = [(k, [1e9 + 1000.0 * k, float(k % 3)]) for k in range(20)]
    got = {r.vec_id: r for r in whitening.whiten(vector_table(spark, rows)).filter("component = 1").collect()}
    _, deviation, _, _ = naive_whitening([np.float32(v).tolist() for _, v in rows], 1)
    assert [int(got[k].deviation) for k in range(20)] == deviation


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3, [(1, None)]])
def test_whitening_without_variance_gives_no_rows(spark, rows):
    assert whitening.whiten(vector_table(spark, rows)).collect() == []


def test_whitening_leaves_out_components_without_variance(spark):
    rows = [(k, [float(k), float(k), float(k * k)]) for k in range(30)]
    got = whitening.whiten(vector_table(spark, rows)).collect()
    assert {r.component for r in got} == {1, 2} and abs(sum({r.component: r.explained for r in got}.values()) - 1) < 1e-9


# -- spelling variants


def edits(a, b):
    """Edit distance by the textbook recurrence."""
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def naive_variants(table, min_length=7, min_count=2, ratio=10):
    lower = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    counts = Counter()
    for row in table:
        for run in re.findall("[A-Za-zÀ-ÿ]+", row[1] or ""):
            run = run.translate(lower)
            h = zlib.crc32(f"{'' if row[0] is None else row[0]}:{run}".encode())
            counts[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= min_length and n >= min_count}
    near = {w: [v for v in counts if abs(len(v) - len(w)) < 2 and edits(w, v) == 1] for w in counts}
    best = {w: min(near[w], key=lambda v: (-counts[v], v)) for w in counts if near[w]}
    form = {w: v for w, v in best.items() if counts[v] >= ratio * counts[w]}
    out = {}
    for w, n in counts.items():
        root = w
        while root in form:
            root = form[root]
        out[w] = (w, n, form.get(w), counts.get(form.get(w)), len(near[w]), root)
    return sorted(out.values())


def variants(docs, table, **parameters):
    return sorted(tuple(r) for r in spelling.group_variants(docs(table), **parameters).collect())


def mutate(rng, word, letters):
    at = rng.randrange(len(word) + 1)
    return rng.choice([word[:at] + rng.choice(letters) + word[at:], word[:at] + word[at + 1:],
                       word[:at] + rng.choice(letters) + word[at + 1:]])


@pytest.mark.parametrize("letters", ["ab", "abcdeÀ÷ÿ", "abcdefghijklmnopqrstuvwxyz"])
def test_variants_equal_brute_force(docs, letters):
    """Words of few letters share all their grams, words of many hardly any."""
    rng = random.Random(len(letters))
    words = ["".join(rng.choice(letters) for _ in range(rng.randint(6, 11))) for _ in range(40)]
    words += [mutate(rng, rng.choice(words), letters) for _ in range(160)]
    table = [(k, " ".join(rng.choice(words) for _ in range(60))) for k in range(60)]
    table += [(100 + k, (words[k] + " ") * 300) for k in range(5)]
    assert variants(docs, table) == naive_variants(table)


def test_variants_of_odd_rows(docs):
    table = ODD + [(20, "Letters LETTERS letters lettars lettars"), (None, "lettërs " * 3 + "letters " * 40),
                   (21, "x" * 5000 + " " + "x" * 5001), (22, "x" * 5000 + " " + "x" * 5001), (23, "naïveté-naïvetés " * 2)]
    assert variants(docs, table) == naive_variants(table)
    assert variants(docs, []) == []


def test_forms_are_followed_to_the_root(docs):
    table = [(k, "abcdefgh " * 2000 + "abcdefgx " * 150 + "abcdefyx " * 12 + "abcdezyx abcdezyx") for k in range(1)]
    got = {r[0]: r for r in variants(docs, table, ratio=5)}
    assert got == {r[0]: r for r in naive_variants(table, ratio=5)}
    assert got["abcdefyx"][5] == "abcdefgh" and got["abcdefgh"][2] is None


def test_pivots_are_the_least_disjoint_pair():
    rng = random.Random(8)
    for _ in range(500):
        word = "".join(rng.choice("abc") for _ in range(rng.randint(4, 12)))
        grams = sorted({word[i:i + 2] for i in range(len(word) - 1)})
        rng.shuffle(grams)
        rank = {g: k for k, g in enumerate(grams)}
        pivots, prefix, end = spelling.pivots_and_prefix(word, rank)
        ranks = [rank[word[i:i + 2]] for i in range(len(word) - 1)]
        three = sorted(range(len(ranks)), key=lambda i: (ranks[i], i))[:3]
        assert end == ranks[three[2]] and prefix == [i for i in range(len(ranks)) if ranks[i] <= end]
        want = min(ranks[i] + ranks[j] for i in three for j in three if i + 2 <= j)
        assert pivots[0] + 2 <= pivots[1] and set(pivots) <= set(three) and sum(ranks[i] for i in pivots) == want
