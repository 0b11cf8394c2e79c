"""License scan, SentencePiece codec, byte-level BPE, exact dedup: against SQL, the
libraries and brute force, with odd rows."""

import hashlib
import random
import zlib

import duckdb
import numpy as np
import public_tokenizers
import pytest

from runlens.llm import exact_dedup, license_scan, packing, sentencepiece_codec
from runlens.llm.byte_bpe import ByteBpe
from runlens.llm.queries import vocabulary

from .conftest import ODD

BLANKS = dict.fromkeys(map(ord, " \t\n\x0b\x0c\r"))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def duck(sql, table):
    import pyarrow as pa
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": pa.array([r[0] for r in table], pa.int64()),
                                        "text": pa.array([r[1] for r in table], pa.string())}))
    return sorted(con.execute(sql).fetchall(), key=repr)


LICENSED = [(1, "CC BY and cc-by; All rights reserved."), (2, "GNU GENERAL PUBLIC LICENSE general public license"),
            (3, "This work is licensed under the GNU General Public License, version 3."), (4, "general publiclicense"),
            (5, "Licensed under CC BY-NC 4.0. Released under the MIT License."), (6, "all\nrights\x00reserved cc by"),
            (7, "version 2.0 of the Apache License"), (10, "Licensed under the MIT License"),
            (11, "MIT License. mit license"), (12, "GNU General Public License version 2 or later"),
            (13, "apache license version 2.0 applies"), (14, "the license mit, and the public general license"),
            (15, "see: " + license_scan.NOTICES[16][1] + " " + license_scan.NOTICES[18][1][:300]),
            (16, "x " * 50 + " ".join(license_scan.NOTICES[17][1].split()[20:])), (8, "cc cc by by cc by"), (9, "İcc by K cc by")]


@pytest.mark.parametrize("table", [LICENSED, ODD, []])
def test_licenses_match_sql(docs, table):
    assert rows(license_scan.scan_licenses(docs(table))) == duck(license_scan.license_sql(), table)


def test_license_labels(docs):
    got = {r.doc_id: r for r in license_scan.scan_licenses(docs(LICENSED)).collect()}
    assert (got[1].n_base, got[1].first_word, got[1].last_word, got[1].base_labels) == (3, 0, 5, "cc-by,reserved")
    assert got[3].labels == "gpl,gpl-3.0" and got[3].score == 1.0
    assert got[4].n_base == 0 and got[4].first_word is None and got[4].labels == "" and got[4].score == 0
    assert got[8].n_base == 2
    assert got[15].labels == "bsd,mit" and got[15].score == 1.0


def test_license_labels_of_other_wordings(docs):
    """The key phrase alone gives the label, also at the text's first word; the
    template's other words only count for the score."""
    table = [(100 + k, " ".join(t.key)) for k, t in enumerate(license_scan.build_index())]
    table += [(200 + k, "x " * 30 + " ".join(t.key) + " y") for k, t in enumerate(license_scan.build_index())]
    table += [(1, "Licensed under the MIT License"), (2, "apache license version 2"),
              (3, "This program is licensed under the GNU General Public License, version 2"),
              (4, "mit license. Released under the MIT License"), (5, "license mit"), (6, "MIT License\nCopyright")]
    got = {r.doc_id: r for r in license_scan.scan_licenses(docs(table)).collect()}
    for k, t in enumerate(license_scan.build_index()):
        for r in (got[100 + k], got[200 + k]):
            assert t.label in r.labels.split(",")
            assert r.score >= (0.5 if t.base else len(t.key) / len(t.words))
    assert got[1].labels == got[6].labels == "mit" and got[1].score == 4 / 5 and got[6].score == 2 / 5
    assert got[3].labels == "gpl,gpl-2.0" and got[3].score == 11 / 12
    assert got[4].labels == "mit" and got[4].score == 1
    assert got[2].labels == got[5].labels == "" and got[2].score == got[5].score == 0


def test_license_scan_is_native(docs):
    plan = license_scan.scan_licenses(docs(LICENSED))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Arrow", "Pandas", "Exchange"))


@pytest.fixture(scope="module")
def pieces():
    import sentencepiece
    path = public_tokenizers.path("piece_bpe_32k.model")
    return sentencepiece_codec.PrefixTableCodec(path, memo_limit=500), sentencepiece.SentencePieceProcessor(model_file=path)


ALPHABET = [*"abctheing  .,\n\t1290é▁ß漢字日😀éçñ́\x00 <>/s²½Ⅷ_-'\"()AZαжعਾ\x1c\x85\xa0!?",
            "  ", "    ", " the", " ing", "\n\n", "▁▁▁", " " * 17, "<s>", "</s>", "<0x0A>", "<|endoftext|>", "'s"]


def random_texts(n, seed):
    r = random.Random(seed)
    return ["".join(r.choice(ALPHABET) for _ in range(r.randint(0, 16))) for _ in range(n)]


def test_sentencepiece_equals_library(pieces):
    ours, lib = pieces
    texts = random_texts(4000, 1) + [" " * k + "the" + " " * k for k in range(40)] + [t for _, t in ODD if t]
    for t in texts:
        want = lib.encode(t)
        assert ours.encode(t) == want, t
        assert ours.decode_parts(ours.encode_parts(t)) == lib.decode(want), t


def test_prefix_table_holds_last_tokens(pieces):
    ours, _ = pieces
    seg = "▁thingtionable"
    last, length = ours.last_tokens(seg)
    for end in range(1, len(seg) + 1):
        assert last[end - 1] == ours.pieces[ours.merge(seg[:end])[-1]]
        assert length[end - 1] == len(ours.merge(seg[:end])[-1])


def test_sentencepiece_query(odd, pieces):
    _, lib = pieces
    out = sentencepiece_codec.encode_decode(odd, vocabulary("piece_bpe_32k.model"), with_ids=True).collect()
    assert sorted(map(repr, (r.doc_id for r in out))) == sorted(repr(r[0]) for r in ODD)
    want = {}
    for i, t in ODD:
        ids = lib.encode(t or "") + [2]
        want.setdefault(i, set()).add((len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                                       hashlib.sha256(lib.decode(ids).encode()).hexdigest()))
    for r in out:
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) in want[r.doc_id]
        assert len(r.ids) == r.n_tokens and r.ids[-1] == 2


def test_byte_bpe_equals_library():
    from tokenizers import Tokenizer
    path = vocabulary("byte_bpe_50k.json")
    ours, lib = ByteBpe(path), Tokenizer.from_file(path)
    for t in random_texts(4000, 2) + [t for _, t in ODD if t]:
        assert ours.encode(t) == lib.encode(t, add_special_tokens=False).ids, t


def brute_dedup(table):
    groups = {}
    for i, t in table:
        groups.setdefault((t or "").translate(BLANKS), []).append((-len(t or ""), i is None, i))
    out = []
    for i, t in table:
        key = (t or "").translate(BLANKS)
        keep = min(groups[key])[2]
        out.append((i, keep, len(groups[key]), i == keep, hashlib.sha256(key.encode()).hexdigest()))
    return sorted(out, key=repr)


@pytest.mark.parametrize("table", [ODD, [], [(i, f"text {i % 7}" + " " * (i % 3)) for i in range(200)]])
def test_exact_dedup(docs, table):
    assert rows(exact_dedup.exact_dedup(docs(table))) == brute_dedup(table)


def test_trie_keeps_smallest_owner_and_spills():
    r = random.Random(3)
    keys = [bytes(r.choice(b"ab") for _ in range(r.randint(0, 9))) for _ in range(3000)]
    trie, want = exact_dedup.PatriciaTrie(), {}
    for n, k in enumerate(keys):
        trie.insert(k, (n % 50,))
        best, count = want.get(k, ((99,), 0))
        want[k] = (min(best, (n % 50,)), count + 1)
    spilled = list(trie.spill())
    rest = list(trie.drain())
    assert spilled and len(spilled) + len(rest) == len(want)
    assert {k: (o, c) for k, o, c in spilled + rest} == want


def test_spilled_subtrees_meet_again(docs):
    table = [(i, f"{i % 40} " + "filler " * 30) for i in range(400)]
    got = exact_dedup.owners(docs(table), trie_bytes=500).collect()
    assert sorted((r.keep_id, r.group_size) for r in got) == [(i, 10) for i in range(40)]


def check_packing(out, table, capacity=packing.CAPACITY):
    from tokenizers import Tokenizer
    lib = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    want = []
    for i, t in table:
        ids = np.array(lib.encode(t or "", add_special_tokens=False).ids + [2], "<u4")
        first = (len(ids) - 1) % capacity + 1
        cuts = [0, *range(first, len(ids) + 1, capacity)]
        want += [(i, k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts, cuts[1:]))]
    assert sorted(map(repr, want)) == sorted(repr(tuple(r)[:5]) for r in out)
    at = {}
    for r in sorted(out, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == at.get(r.sequence_id, 0)
        at[r.sequence_id] = r.offset + r.length
    assert all(v <= capacity for v in at.values())
    return len(at), sum(r.length for r in out)


@pytest.mark.parametrize("table", [ODD, [], [(1, "x")], [(i, "word " * (37 * i % 1500)) for i in range(400)]])
def test_packing(docs, table):
    used, tokens = check_packing(packing.pack_documents(docs(table), vocabulary("byte_bpe_50k.json")).collect(), table)
    assert used <= 1.06 * tokens / packing.CAPACITY + 1


def test_configurations_cover_demand():
    r = random.Random(4)
    counts = {}
    for _ in range(5000):
        k = r.randint(129, 1023)
        counts[k] = counts.get(k, 0) + 1
    grouped = packing.linear_groups(counts, 40)
    sizes = np.array([s for s, _ in grouped])
    demand = np.array([sum(counts[k] for k in ks) for _, ks in grouped])
    plans = packing.optimise(sizes, demand, 1024)
    held = sum(np.array(c) * n for c, n in plans)
    assert (held >= demand).all() and all(np.array(c) @ sizes <= 1024 for c, _ in plans)
    assert sorted(k for _, ks in grouped for k in ks) == sorted(counts)
