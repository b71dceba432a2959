"""Tokens, language ID, perplexity, decontamination, licenses and quotes against brute force."""

import hashlib
import math
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from pagemill.llm import bpe, language_id, token_files
from pagemill.llm.decontamination import contamination, drop_contaminated, item_windows, search, build_index
from pagemill.llm.language_id import codewords, held_out, identify, train
from pagemill.llm.license_scan import BASE, scan
from pagemill.llm.perplexity import build_model, judge
from pagemill.llm.queries import QUERIES
from pagemill.llm.quote_links import reply_ordered
from tests.llm.test_dedup import LOW

PATH = public_tokenizers.path("word_bpe_49k.json")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
PIECES = [
    "a", "b", "the", "ing", "ll", "'", "'s", "'ll", "’", " ", "\n", "1", "23", "!", "!!", "é", "é", "́", "ß", "İ", "Σ", "中文", "한",
    "<|endoftext|>", "<|", "|>", "endoftext", "😀", "\x1c", "\xa0", "ﬁ", "²", "aaaa", "hello", "क्षि", "া",
]


def test_tree_equals_whole_text():
    r = random.Random(11)
    tok = bpe.tokenizer(PATH)
    one = bpe.Encoder(PATH, keep=50)
    for _ in range(1500):
        some = r.sample(PIECES, r.randint(1, 12))
        text = "".join(r.choice(some) for _ in range(r.randint(1, 120)))
        want = tok.encode(text, add_special_tokens=False).ids
        parts = [bpe.Part.of(tok, x) for x in bpe.halves(text, r.choice([3, 7, 20, 50]))]
        assert bpe.tree(tok, parts, r.choice([1, 4, 16])).ids.tolist() == want
        ids, decoded = one.encode([text.encode()])[0]
        assert np.frombuffer(ids, "<u4").tolist() == want
        assert decoded.decode() == tok.decode(want, skip_special_tokens=False)


def test_encode(docs, rows, none):
    tok = bpe.tokenizer(PATH)
    got = bpe.encode(docs, PATH, piece=500)
    assert got.columns == [*(c for c in docs.columns if c not in ("ids", "decoded")), "ids", "decoded"]
    want = Counter()
    for r in rows:
        ids = tok.encode(r[1] or "", add_special_tokens=False).ids
        want[(r[0], r[1], np.array(ids, "<u4").tobytes(), tok.decode(ids, skip_special_tokens=False))] += 1
    assert Counter((r.doc_id, r.text, bytes(r.ids), r.decoded) for r in got.collect()) == want
    assert bpe.encode(none, PATH).count() == 0


def test_token_files(spark, docs, rows, none, tmp_path, monkeypatch):
    monkeypatch.setattr(token_files, "BLOCK_TOKENS", 700)
    monkeypatch.setattr(token_files, "GROUP", 3)
    tok = bpe.tokenizer(PATH)
    folder = f"file://{tmp_path}/tokens"
    blocks, table = token_files.write_token_files(docs, PATH, folder, 2, file_tokens=5000)
    got = token_files.read_token_files(blocks, table, folder).orderBy("start").collect()
    want = sorted((r[0], np.array([*tok.encode(r[1] or "", add_special_tokens=False).ids, 2], "<u4").tobytes()) for r in rows)
    assert [(r.doc_id, bytes(r.ids)) for r in got] == want
    assert [r.start for r in got] == (np.cumsum([len(i) // 4 for _, i in want]) - [len(i) // 4 for _, i in want]).tolist()
    assert len(list((tmp_path / "tokens").glob("part-*.rans"))) > 1
    assert token_files.round_trip(none, PATH).count() == 0
    least = -(1 << 63)
    null = spark.createDataFrame([(None, "b"), (1, None), (least, "b")], "doc_id long, text string")
    got = [(r.doc_id, len(r.ids)) for r in token_files.round_trip(null, PATH).orderBy("start").collect()]
    assert got == [(None, 8), (least, 8), (1, 4)]


def test_damaged_block():
    table = token_files.Table(np.array([5, 0, 3, 1]))
    tokens = np.array([0, 2, 3, 0, 0, 2, 0])
    states, lanes = token_files.encode_blocks(table, [tokens, tokens[:0]])
    block = token_files.pack_block([None, 5], [tokens[:3], tokens[3:]], states[0], lanes[: token_files.LANES])
    ids, sizes, state, words = token_files.unpack_block(block)
    assert ids.to_pylist() == [None, 5] and sizes.tolist() == [3, 4]
    assert token_files.decode_blocks(table, np.array([7]), state[None], words)[0].tolist() == tokens.tolist()
    for at in (0, 30, len(block) - 1):
        with pytest.raises(ValueError, match="damaged"):
            token_files.unpack_block(block[:at] + bytes([block[at] ^ 1]) + block[at + 1 :])


def test_codewords():
    for classes in (1, 2, 4, 6, 9, 30):
        code = codewords(classes)
        assert len({tuple(c) for c in code}) == classes
        if classes > 2:
            apart = (code[:, None] != code[None]).sum(-1)[~np.eye(classes, dtype=bool)].min()
            assert apart >= code.shape[1] // 4


def test_language_id(spark, sf_dir, docs, none):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = train(table.where(~held_out()))
    found = identify(table, model).where(held_out()).where("lang is not null").toPandas()
    assert (found.lang == found.lang_pred).mean() > 0.98
    assert found.score.between(0, 1).all()
    odd = {r.doc_id: r for r in identify(docs.select("doc_id", "text"), model).collect()}
    for i in (112, 113, 114, 119):
        assert odd[i].lang_pred == "und" and odd[i].score == 0 and odd[i].ambiguous
    assert identify(none, model).count() == 0
    untrained = identify(docs.select("doc_id", "text"), train(none)).collect()
    assert {r.lang_pred for r in untrained} == {"und"}


def test_language_id_equals_direct_counting(spark):
    """Margins, losses and choices once more, trigram by trigram."""
    r = random.Random(11)
    alphabets = {"aa": "abcde ", "bb": "defgh ", "cc": "ghijé "}
    rows = [(i, "".join(r.choice(alphabets[lang]) for _ in range(r.randint(0, 60))), lang) for i in range(60) for lang in alphabets]
    rows += [(1000, None, "aa"), (None, "abc", None), (1001, "12 !", "bb"), (1002, "Ab ab", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    mask = (1 << 64) - 1

    def grams(text):
        shown = f" {(text or '').lower()} "
        points = [ord(c) if c.isalpha() else 0 for c in shown]
        out = []
        for i, p in enumerate(points):
            if p:
                h = (points[i - 1] * 0x9E3779B97F4A7C15 + p * 0xC2B2AE3D27D4EB4F + points[i + 1] * 0x165667B19E3779F9) & mask
                h ^= h >> 29
                out.append((h * 0xBF58476D1CE4E5B9 & mask) >> 64 - 15)
        return out

    counts = {lang: Counter(g for _, t, x in rows if x == lang for g in grams(t)) for lang in alphabets}
    totals = {lang: sum(c.values()) + 0.1 * language_id.BUCKETS for lang, c in counts.items()}
    rate = lambda lang, g: (counts[lang][g] + 0.1) / totals[lang]
    names, code = sorted(alphabets), codewords(3)
    every = range(language_id.BUCKETS)
    weights, trust = [], []
    for bit in range(code.shape[1]):
        ones, others = ([n for n, w in zip(names, code[:, bit]) if (w > 0) == side] for side in (True, False))
        weights.append([math.log(sum(rate(n, g) for n in ones) / len(ones)) - math.log(sum(rate(n, g) for n in others) / len(others)) for g in every])
        trust.append(max(0.05, min(sum(rate(n, g) * weights[-1][g] for g in every) * w for n, w in zip(names, code[:, bit]))))
    trust = [t * len(trust) / sum(trust) for t in trust]
    for got in identify(table, train(table)).collect():
        own = grams(got.text)
        if not own:
            assert (got.lang_pred, got.score, got.ambiguous) == ("und", 0, True)
            continue
        margins = [sum(w[g] for g in own) / len(own) * min(len(own), language_id.EVIDENCE) for w in weights]
        losses = [sum(math.log1p(math.exp(-b * m)) * t for b, m, t in zip(word, margins, trust)) for word in code.tolist()]
        shares = [math.exp(min(losses) - x) for x in losses]
        score = max(shares) / sum(shares)
        assert got.lang_pred == names[losses.index(min(losses))]
        assert abs(got.score - score) < 1e-3 and (got.ambiguous == (score < language_id.CLEAR) or abs(score - language_id.CLEAR) < 1e-3)


def test_base_rules_and_bands(docs, rows, none):
    got = {r.doc_id: r for r in judge(docs).collect()}
    for r in rows:
        text = r[1] or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        seen, dup = set(), 0
        for line in text.split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        times = Counter(tuple(words[j : j + 8]) for j in range(len(words) - 7))
        hit = {x for j in range(len(words) - 7) if times[tuple(words[j : j + 8])] > 1 for x in range(j, j + 8)}
        g = got[r[0]]
        failed = len(words) < 20 or 100 * len(hit) > 30 * len(words)
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == (
            len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit), failed)
        assert not (g.base_failed and g.kept)
    assert judge(none).count() == 0


def test_bands_against_labels(spark, sf_dir):
    folder = os.path.join(os.path.dirname(sf_dir.rstrip("/")), "sf0.01")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    found = [(labels.get(r.doc_id), r.kept) for r in judge(spark.read.parquet(f"{folder}/documents.parquet")).collect() if not r.base_failed]
    bad, good = ([kept for quality, kept in found if quality == q] for q in (0, 1))
    assert bad.count(False) >= 0.15 * len(bad), (bad.count(False), len(bad))
    assert good.count(False) <= 0.03 * len(good), (good.count(False), len(good))


def brute_kneser_ney(texts, order=4):
    """Probabilities of interpolated modified Kneser-Ney by direct counting."""
    counts = [None] * (order + 1)
    counts[order] = Counter(p[j : j + order] for p in (" " * (order - 1) + t.lower() for t in texts) for j in range(len(p) - order + 1))
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    size = len(counts[1]) + 1
    off, whole = {}, {}
    for n in range(1, order + 1):
        met = Counter(counts[n].values())
        y = met[1] / (met[1] + 2 * met[2]) if met[1] + met[2] else None
        d = {k: max(0.1, min(k - 0.1, k - (k + 1) * y * met[k + 1] / met[k])) if met[k] and y is not None else 0.5 * k for k in (1, 2, 3)}
        off[n], whole[n] = defaultdict(float), Counter()
        for g, c in counts[n].items():
            whole[n][g[:-1]] += c
            off[n][g[:-1]] += min(d[min(c, 3)], c)
        off[n, "d"] = d

    def p(g):
        if not g:
            return 1 / size
        n, context = len(g), g[:-1]
        if not whole[n][context]:
            return p(g[1:])
        c = counts[n][g]
        left = c - min(off[n, "d"][min(c, 3)], c) if c else 0
        return (left + off[n][context] * p(g[1:])) / whole[n][context]

    return p


def test_kneser_ney(spark):
    r = random.Random(2)
    texts = ["".join(r.choice("aab cde") for _ in range(r.randint(1, 60))) for _ in range(40)] + ["", None]
    model = build_model(spark.createDataFrame([(t, "xx") for t in texts], "text string, lang string"))
    p = brute_kneser_ney([t or "" for t in texts])
    for text in ("aab", "cdecde", "zzz", "a z b"):
        padded = " " * 3 + text
        grams = np.array([sum(ord(padded[j + 3 - b]) << 12 * b for b in range(4)) for j in range(len(text))])
        want = [np.log(p(padded[j : j + 4])) for j in range(len(text))]
        assert np.allclose(model.log_probabilities("xx", grams), want, atol=1e-4)


def brute_contamination(rows, items, size=10):
    windows = defaultdict(set)
    for item, text in items:
        words = ALNUM.findall((text or "").translate(LOW))
        if item is not None and words:
            for j in range(max(1, len(words) - size + 1)):
                windows[tuple(words[j : j + size])].add(item)
    out = {}
    for r in rows:
        words, hit, found = ALNUM.findall((r[1] or "").translate(LOW)), set(), set()
        for n in {len(w) for w in windows}:
            for j in range(len(words) - n + 1):
                if (w := tuple(words[j : j + n])) in windows:
                    found |= windows[w]
                    hit |= set(range(j, j + n))
        out[r[0]] = (len(words), len(hit), sorted(found))
    return out


def test_contamination(docs, rows, none, items, benchmark):
    want = brute_contamination(rows, items)
    got = contamination(docs, benchmark).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_words, r.n_hit, r["items"]) for r in got} == want
    assert all(set(r["items"]) <= set(r.near) for r in got)
    kept = drop_contaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in rows if not want[r[0]][1])
    assert contamination(none, benchmark).count() == 0
    assert {r.n_hit for r in contamination(docs, benchmark.where("false")).collect()} == {0}


def test_blocks_and_proximity(spark, docs, rows, items, benchmark):
    index = build_index(docs)
    whole = sorted(map(str, search(index, item_windows(benchmark)).collect()))
    assert sorted(map(str, search(index, item_windows(benchmark), block=2).collect())) == whole
    near = spark.createDataFrame([(1, "one two extra three four"), (2, "one two three four"), (3, "one two x y z three four"), (4, "four three two one")], "doc_id long, text string")
    item = spark.createDataFrame([("i", "one two three four")], "item_id string, text string")
    found = {r.doc_id: (r.n_hit, r.near) for r in contamination(near, item, slop=1).collect()}
    assert found == {1: (0, ["i"]), 2: (4, ["i"]), 3: (0, []), 4: (0, [])}
    want = {r.doc_id: r.near for r in contamination(docs, benchmark, slop=2).collect()}
    listed = [(i, ALNUM.findall((t or "").translate(LOW))) for i, t in items if i]
    for row in rows:
        words, near = ALNUM.findall((row[1] or "").translate(LOW)), set()
        for name, item in listed:
            for w in {tuple(item[j : j + 10]) for j in range(max(1, len(item) - 9))} if item else ():
                if set(w) <= set(words):
                    inside = lambda a, i, x: x in words[max(0, a + i - 2) : max(0, a + i + 3)]  # noqa: B023, E731
                    near |= {name} if any(all(inside(a, i, x) for i, x in enumerate(w)) for a in range(-2, len(words) + 2)) else set()
        assert want[row[0]] == sorted(near)


def test_op1_near_matches(spark, tmp_path):
    words = [f"w{i}" for i in range(30)]
    texts = [words, [*words[:5], "in", *words[5:10]], [*words[3:7], *words[8:14]], [words[1], words[0], *words[2:10]], words[::-1]]
    spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    items = [("i", " ".join(words[:10])), ("j", " ".join(words[3:13]))]
    spark.createDataFrame(items, "item_id string, text string").write.parquet(f"{tmp_path}/benchmark.parquet")

    def near(text):
        inside = lambda a, i, x: x in text[max(0, a + i - 2) : max(0, a + i + 3)]
        return [n for n, t in items if any(all(inside(a, i, x) for i, x in enumerate(t.split())) for a in range(-2, len(text) + 2))]

    want = {i: (len(near(t)), hashlib.sha256(",".join(near(t)).encode()).hexdigest()) for i, t in enumerate(texts)}
    assert "op1_near_matches" in QUERIES and {n for n, _ in want.values()} == {0, 1, 2}
    assert {r.doc_id: (r.n_near, r.near_sha256) for r in QUERIES["op1_near_matches"](spark, str(tmp_path)).collect()} == want


def test_license_scan(spark, docs, rows, none):
    texts = {
        1: "Released under the MIT License.\nfoo\nunder the mit license", 2: "Licensed under the Apache License, Version 2.0.",
        3: "licensed under CC BY-NC 4.0 cc by nc cc by nc", 4: "This work is licensed under the GNU General Public License, version 3.",
        5: "Permission is hereby granted, free of any charge, to any person obtaining a copy of this software and its associated documentation files",
        6: None, 7: "", 8: "mit license under the", 9: "apache license", 10: "word " * 5000 + "under the MIT license",
    }
    table = spark.createDataFrame([(i, t, "x") for i, t in texts.items()] + [(1, texts[1], "x")], "doc_id long, text string, gram string")
    got = scan(table).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        words = ALNUM.findall((texts[r.doc_id] or "").translate(LOW))
        places = [(j, label) for p, label in BASE.items() for j in range(len(words)) if words[j : j + len(p.split())] == p.split()]
        at = [j for j, _ in places]
        assert r.n_words == len(words)
        assert (r.n_base, r.first_word, r.last_word) == (len(at), min(at, default=None), max(at, default=None))
        assert r.base_labels == ",".join(sorted({label for _, label in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) or not r.base_labels
    by = {r.doc_id: r for r in got}
    assert by[4].labels == "gpl-3" and by[5].labels == "mit" and 0 < by[5].score < 1
    assert by[6].labels == by[7].labels == by[8].labels == by[9].labels == "" and by[8].score == 0
    assert scan(none).count() == 0
    assert {r.n_base for r in scan(docs).collect()} == {0}


def test_quote_links(spark):
    rows = [
        (1, 0, "user", "Shall we meet?\nIn the  Park at noon.\nok"),
        (1, 1, "assistant", "> shall we meet?\nYes.\nok"),
        (1, 2, "user", ">> Shall we meet?\n> yes.\n> ok\nGood."),
        (1, 3, "assistant", "> in the park at NOON.\n\nFine"),
        (2, 0, "user", "> Good.\nLinked from elsewhere"),
        (2, 1, "user", "> never said\nalone"),
        (2, 2, "user", "> alone"),
        (3, 0, "user", None), (3, 1, "user", ""), (None, 0, "user", "> Good."), (1, 1, "assistant", "> shall we meet?\nYes.\nok"),
    ]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = reply_ordered(table).collect()
    assert len(got) == len(rows)
    by = {(r.conv_id, r.turn): r for r in got}
    parents = {k: (r.parent_conv, r.parent_turn) for k, r in by.items() if r.parent_conv is not None}
    assert parents == {(1, 1): (1, 0), (1, 2): (1, 1), (1, 3): (1, 0), (2, 0): (1, 2), (2, 2): (2, 1)}
    assert [by[k].depth for k in ((1, 0), (1, 1), (1, 2), (2, 0), (2, 2))] == [0, 1, 2, 3, 1]
    assert {(by[k].thread_conv, by[k].thread_turn) for k in ((1, 0), (1, 1), (1, 2), (1, 3), (2, 0))} == {(1, 0)}
    assert by[1, 2].body == "Good." and by[1, 2].levels == 2 and by[1, 3].body == "\nFine" and by[2, 2].body == ""
    assert by[3, 0].body is None and by[3, 1].body == "" and (by[2, 1].n_quoted, by[2, 1].n_linked) == (1, 0)
    assert reply_ordered(table.where("false")).count() == 0


def test_long_reply_chain(spark):
    rows = [(1, t, "user", (f"> message {t - 1}\n" if t else "") + f"message {t}") for t in range(37)]
    got = reply_ordered(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()
    assert {r.turn: (r.depth, r.thread_turn) for r in got} == {t: (t, 0) for t in range(37)}


def test_digest_helpers():
    assert zlib.crc32(np.array([2], "<u4").tobytes()) == zlib.crc32(b"\x02\0\0\0")
    assert hashlib.sha256(b"").hexdigest().startswith("e3b0c442")
    assert bpe.rows_of(pa.array(["a", None, "é"])) == [b"a", b"", "é".encode()]


def test_perplexity_is_exact_beyond_the_entries_held_in_memory(spark):
    """Rare entries come by joins: every text has the value of the whole table, seen by the model or not."""
    import math

    from pagemill.llm.perplexity import ORDER, SYMBOL_BITS, looked_up, model_table, scores

    words = [f"w{i * i % 97}x{i % 13}" for i in range(400)]
    rows = [(i, " ".join(words[i * 7 : i * 7 + 30]), ("xx", "yy", None)[i % 3]) for i in range(50)] + [(99, "", "xx"), (98, None, "zz")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    table = {(r.kind, r.lang, r.gram): r.value for r in model_table(docs).collect()}
    assert len(table) > 500

    def value(lang, gram):
        added = 0.0
        for order in range(ORDER, 0, -1):
            low = gram & (1 << SYMBOL_BITS * order) - 1
            if (order, lang, low) in table:
                return added + table[order, lang, low]
            added += table.get((10 + order, lang, low >> SYMBOL_BITS), 0.0)
        return added + table.get((0, lang, 0), -math.log(1 << SYMBOL_BITS))

    def of(text, lang):
        points = [ord(c) for c in " " * (ORDER - 1) + text]
        grams = [sum(points[i - b] << SYMBOL_BITS * b for b in range(ORDER)) for i in range(ORDER - 1, len(points))]
        return -sum(value(lang, g) for g in grams) / len(grams) if grams else None

    unseen = spark.createDataFrame([(1, "q#w9x1 zzz", "xx"), (2, "w4", "nn")], "doc_id long, text string, lang string")
    for limit in (40, 1 << 20):
        model = build_model(docs, limit)
        assert sum(len(k) for k, _ in model.held.values()) <= limit and (model.rest is None) == (limit > 40)
        for given in (docs, unseen):
            for r, got in zip(sorted(given.collect(), key=lambda r: r.doc_id), sorted(scores(given, model).collect(), key=lambda r: r.doc_id)):
                wanted = of(r.text or "", r.lang or "und")
                assert got.log_perplexity is wanted is None or math.isclose(got.log_perplexity, wanted, rel_tol=1e-6)
    assert judge(docs, limit=40).count() == len(rows)
    some = spark.createDataFrame([("xx", 0), ("nn", 5)], "lang string, gram long")
    assert {(r.lang, r.gram): round(r.value, 6) for r in looked_up(some, model_table(docs)).collect()} == {(l, g): round(value(l, g), 6) for l, g in (("xx", 0), ("nn", 5))}


def test_encoder_of_ids_keeps_no_tokens():
    texts = ["Straße élan, ÉLAN. İstanbul ΑΣ", "don't 10.5 x.. a1b Hello,World!", "", None, " \n\t ", "hello hello. HELLO! 日本語。"]
    encoder = bpe.Encoder(PATH, decoded=False)
    made = encoder.id_bytes(pa.array(texts))
    want = [bpe.tokenizer(PATH).encode(t or "", add_special_tokens=False).ids for t in texts]
    assert [np.frombuffer(m, "<u4").tolist() for m in made] == want
    assert encoder.ids and not encoder.tokens
    assert bpe.lean(PATH) is not bpe.tokenizer(PATH)
