"""Token alignment, prefix BPE and the Merkle manifest against brute force and the tokenizers' own libraries."""

import base64
import hashlib
import random
import zlib
from collections import Counter

import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from pagemill.llm import merkle_manifest as merkle
from pagemill.llm import prefix_bpe, token_alignment
from pagemill.llm.queries import BYTE_LEVEL, PIECES, RANKS, tokenizer_path

A, B, RANK_FILE = tokenizer_path(BYTE_LEVEL), tokenizer_path(PIECES), tokenizer_path(RANKS)
ALPHABET = [
    "a", "b", "aa", " ", "  ", "\n", "'s", "'ll", "'", "'re", "é", "́", "日", "本", "한", "0", "12", "!", "!!", "\t", "x" * 9, "the", "ing", " in", " ",
    "👍", "<|endoftext|>", "<s>", "</s>", "<unk>", "<0x41>", "▁", "\x1c", "\x85", "​", "ß", "²", "½", "_", "\r\n", "　",
]


def strange(seed, n, size=30):
    r = random.Random(seed)
    for _ in range(n):
        yield "".join(r.choice(ALPHABET) for _ in range(r.randint(0, size)))


@pytest.fixture(scope="module")
def hostile(spark, docs):
    """The shared fixture with null ids, two texts under one id and strange texts."""
    more = [(None, t, "en", "s", len(t)) for t in strange(5, 6)] + [(None, None, None, None, None), (7, "Another TEXT under seven", "en", "s", 24)]
    more += [(1000 + i, t, ["en", "", "Ωx", None][i % 4], None, None) for i, t in enumerate(strange(6, 40))]
    return docs.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)


# Token alignment


def brute_tokens(text):
    of = token_alignment.tokenizers(A, B)
    if not text:
        return None
    a, b, raw = of.a.encode(f" {text}", add_special_tokens=False).ids, of.b.encode(text), f" {text}".encode()
    placed = []
    for ids, names in ((a, of.bytes_a), (b, of.bytes_b)):
        if b"".join(names[i] for i in ids) != raw:
            return None
        at, out = 0, []
        for i in ids:
            out.append((at, at + len(names[i]), i))
            at += len(names[i])
        placed.append(out)
    links = [(x[2], y[2]) for x in placed[0] for y in placed[1] if x[0] < y[1] and y[0] < x[1]] if len(a) * len(b) < 40_000 else []
    if not links:  # the same by sorted bounds, for long texts
        first = 0
        for x in placed[0]:
            while placed[1][first][1] <= x[0]:
                first += 1
            k = first
            while k < len(b) and placed[1][k][0] < x[1]:
                links.append((x[2], placed[1][k][2]))
                k += 1
    ends = sorted({x[1] for x in placed[0]} & {y[1] for y in placed[1]})
    group_of = [{}, {}]
    for side in (0, 1):
        k = 0
        for x in placed[side]:
            while ends[k] < x[1]:
                k += 1
            group_of[side].setdefault(k, []).append(str(x[2]))
    groups = [f"{','.join(group_of[0][k])}|{','.join(group_of[1][k])}" for k in range(len(ends))]
    return len(a), len(b), groups, links


def brute_alignment(rows):
    made = [(i, brute_tokens(t)) for i, t in rows]
    count = Counter(p for _, m in made if m for p in set(m[3]))
    best = {}
    for (a, _), c in count.items():
        best[a] = max(best.get(a, 0), c)
    out = []
    for i, m in made:
        if m is None:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
        else:
            out.append((
                i, m[0], m[1], len(m[2]), len(m[3]), sum(count[p] == best[p[0]] for p in m[3]), sum(count[p] for p in m[3]),
                hashlib.sha256(";".join(m[2]).encode()).hexdigest(),
            ))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_pairs", [2_000, token_alignment.BLOCK_PAIRS])
def test_alignment_equals_brute_force(hostile, block_pairs):
    got = token_alignment.alignment(hostile, A, B, public_tokenizers.PATTERN, block_pairs)
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    want = brute_alignment([(r.doc_id, r.text) for r in hostile.collect()])
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert any(r[1] == 0 and r[7] == "" for r in want) and any(r[4] > r[3] for r in want)


def test_alignment_of_units_equals_that_of_whole_texts():
    aligner = token_alignment.Aligner(A, B, public_tokenizers.PATTERN, keep=10_000)
    assert aligner.of.ranks is not None
    for text in strange(1, 3_000):
        counts, digest, pairs, links = next(aligner.measure([text]))
        want = brute_tokens(text)
        if want is None:
            assert counts == (0, 0, 0, 0)
        else:
            assert counts == (want[0], want[1], len(want[2]), len(want[3]))
            assert digest == hashlib.sha256(";".join(want[2]).encode()).digest()
            assert dict(zip(pairs.tolist(), links.tolist())) == Counter(a * aligner.width + b for a, b in want[3])


def test_ranks_encode_ascii_as_the_library_does():
    of, r = token_alignment.tokenizers(A, B, public_tokenizers.PATTERN), random.Random(8)
    every = [chr(c) for c in range(128)] + ["the", "ing", "'s", "'ll", "  ", "<|endoftext|>", "0x"]
    texts = ["".join(r.choice(every) for _ in range(r.randint(0, 25))) for _ in range(8_000)]
    texts += [f" {t}" for t in texts] + list(strange(9, 3_000))
    want = [e.ids for e in of.a.encode_batch_fast(texts, add_special_tokens=False)]
    assert [of.ranks.encode_ordinary(t) for t in texts if t.isascii()] == [w for t, w in zip(texts, want) if t.isascii()]
    spaced = [(u, w) for t in texts for u in token_alignment.units(t) for w in [of.a.encode(u, add_special_tokens=False).ids]]
    assert [memoryview(x).cast("i").tolist() for x in of.first([u for u, _ in spaced])] == [w for _, w in spaced]


def test_alignment_empty_table(none):
    assert token_alignment.alignment(none, A, B).count() == 0


def test_packed_numbers():
    import numpy as np

    values = np.array([0, 1, 255, 256, 2**31, 2**32 - 1])
    assert token_alignment.unpacked(token_alignment.packed(values)).tolist() == values.tolist()
    assert token_alignment.unpacked(token_alignment.packed(values[:0])).tolist() == []


# Prefix BPE


@pytest.fixture(scope="module")
def library():
    with open(RANK_FILE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def test_prefix_encode_equals_library(hostile, library):
    got = prefix_bpe.encode(hostile, RANK_FILE, public_tokenizers.PATTERN)
    assert got.columns == [*(c for c in hostile.columns if c not in ("ids", "decoded", "last")), "ids", "decoded"]
    rows = got.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == Counter((r.doc_id, r.text) for r in hostile.collect())
    for r in rows:
        assert list(r.ids) == library.encode_ordinary(r.text or "")
        assert bytes(r.decoded) == (r.text or "").encode()


def test_prefix_encode_strange_texts(library):
    encoder = prefix_bpe.Encoder(RANK_FILE, public_tokenizers.PATTERN, keep=10_000)
    texts = list(strange(2, 5_000)) + ["x" * 5_000, "日本" * 3_000, "ab" * 4_000 + "c", " " * 3_000, "!?" * 2_000]
    for text, ids in zip(texts, encoder.encode(texts)):
        assert memoryview(ids).cast("i").tolist() == library.encode_ordinary(text)


def test_every_prefix_has_its_last_token(library):
    voc = prefix_bpe.vocabulary(RANK_FILE)
    for word in ("internationalisation", "日本語の文字列", "aaaaaaaaaaaaaaaaaaaaa", " thththing"):
        data = word.encode()
        last = voc.extend(data, [])
        for n in range(1, len(data) + 1):
            assert voc.ids(last[:n]) == library._encode_single_piece(data[:n])
        assert voc.extend(data, last[:3]) == last


def test_edits_equal_encoding_anew(library):
    encoder, r = prefix_bpe.Encoder(RANK_FILE, public_tokenizers.PATTERN), random.Random(3)
    for text in strange(4, 1_500, 40):
        text += r.choice(["", "", "ab" * r.randint(20, 150)])
        at, gone = r.randint(0, len(text) + 1), r.choice([0, 0, 1, 2, 9])
        added = "".join(r.choice(ALPHABET) for _ in range(r.randint(0, 3)))
        new, last = encoder.edit(text, encoder.prefixes(text), at, gone, added)
        assert new == text[:at] + added + text[at + gone :]
        assert last.tolist() == encoder.prefixes(new).tolist()
        assert encoder.read_ids(new, last).tolist() == library.encode_ordinary(new)


def test_an_edit_redoes_only_bytes_near_it(monkeypatch):
    encoder = prefix_bpe.Encoder(RANK_FILE, public_tokenizers.PATTERN)
    text = "abcdefghij" * 2_000
    last, done = encoder.prefixes(text), []
    extend = prefix_bpe.Vocabulary.extend
    monkeypatch.setattr(prefix_bpe.Vocabulary, "extend", lambda self, data, own, stop=None: done.append(1) or extend(self, data, own, stop))
    new, after = encoder.edit(text, last, 10_000, 1, "zz")
    assert len(done) < 200
    monkeypatch.undo()
    assert after.tolist() == encoder.prefixes(new).tolist()


def test_edited_table(spark, hostile, library):
    encoded = prefix_bpe.encode(hostile.select("doc_id", "text"), RANK_FILE, public_tokenizers.PATTERN, prefixes=True)
    edits = [(3, 10, 4, "NEW words", 1), (3, 10**9, 0, "'s end", 2), (112, 0, 5, "from nothing", 3), (118, 20_000, 1, None, 4), (None, 0, 0, "x", 5), (-1, 0, 0, "x", 6), (0, None, None, " y", 7)]
    got = prefix_bpe.edited(encoded, spark.createDataFrame(edits, "doc_id long, at long, gone long, added string, text int"), RANK_FILE, public_tokenizers.PATTERN)
    want = Counter()
    for r in hostile.collect():
        for doc_id, at, gone, added, _ in edits:
            if r.doc_id is not None and r.doc_id == doc_id:
                text, at, gone = r.text or "", at or 0, gone or 0
                want[doc_id, text[:at] + (added or "") + text[at:][gone:]] += 1
    rows = got.collect()
    assert Counter((r.doc_id, r.text) for r in rows) == want
    assert all(list(r.ids) == library.encode_ordinary(r.text) for r in rows)


def test_prefix_empty_table(none):
    assert prefix_bpe.encode(none, RANK_FILE, public_tokenizers.PATTERN).count() == 0


# Merkle manifest


def digest(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows):
    def leaf(r, low=False):
        shown = []
        for c in merkle.DOCUMENT:
            v = r[c]
            if low and c == "text" and v is not None:
                v = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in v)
            shown.append("-" if v is None else f"{len(str(v).encode())}:{v}")
        return digest(shown)

    def levels(nodes):
        out = [nodes]
        while len(out[-1]) > 1:
            out.append([digest(out[-1][i : i + 8]) for i in range(0, len(out[-1]), 8)])
        return out

    def up(of, at, own, siblings):
        for nodes in of[:-1]:
            low, slot = at // 8 * 8, at % 8
            run = nodes[low : low + 8]
            siblings += run[:slot] + run[slot + 1 :]
            own, at = digest(run[:slot] + [own] + run[slot + 1 :]), at // 8
        return own

    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = []
    for lang in langs:
        own = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        groups.append((own, levels([leaf(r) for r in own])))
    top = levels([of[-1][0] for _, of in groups])
    out = []
    for k, (own, of) in enumerate(groups):
        for i, r in enumerate(own):
            siblings, hit = [], r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            folded = up(top, k, up(of, i, leaf(r, hit), siblings), siblings)
            out.append((r["doc_id"], of[0][i], of[-1][0], top[-1][0], digest(siblings), folded, folded == top[-1][0]))
    return sorted(out, key=repr)


def made_manifest(docs, height=merkle.LEVELS):
    return merkle.manifest(docs, merkle.DOCUMENT, "lang", "doc_id", merkle.tampered_every_third(), height)


@pytest.mark.parametrize("height", [1, 2, 4])
def test_manifest_equals_brute_force(hostile, height):
    got = made_manifest(hostile, height)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    want = brute_manifest([r.asDict() for r in hostile.collect()])
    assert sorted(map(tuple, got.collect()), key=repr) == want
    assert {r[-1] for r in want} == {True, False}


def test_manifest_of_one_row_and_of_none(spark, none):
    one = spark.createDataFrame([(4, "x", None, None, 1)], "doc_id long, text string, lang string, source string, n_chars long")
    row = made_manifest(one).first()
    assert row.leaf == row.subroot == row.root == digest(["1:4", "-", "-", "1:1", "1:x"])
    assert row.proof_sha256 == digest([]) and row.verified
    assert made_manifest(none).count() == 0


def test_manifest_of_many_languages(spark):
    rows = [(i, f"Text {i}", f"l{i % 70}", "s", 1) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    want = brute_manifest([r.asDict() for r in docs.collect()])
    assert sorted(map(tuple, made_manifest(docs, 1).collect()), key=repr) == want


def test_hash_states_equal_the_library():
    rows = [hashlib.sha256(bytes([i])).digest() for i in range(20)]
    level = merkle.Level(merkle.from_bytes(b"".join(rows)))
    want = [digest([x.hex() for x in rows[i : i + 8]]) for i in (0, 8, 16)]
    assert [bytes(r).hex() for r in merkle.to_bytes(level.parents)] == want


def test_queries_have_their_columns(spark, sf_dir):
    from pagemill.llm.queries import QUERIES

    assert QUERIES["op12_prefix_bpe"](spark, sf_dir).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    got = {r.doc_id: r for r in QUERIES["op12_prefix_bpe"](spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", F.coalesce("text", F.lit("")).alias("text")).collect()
    with open(RANK_FILE, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    enc = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    for d in docs:
        ids = enc.encode_ordinary(d.text)
        assert got[d.doc_id].n_tokens == len(ids)
        assert got[d.doc_id].ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert got[d.doc_id].decoded_sha256 == hashlib.sha256(d.text.encode()).hexdigest()
