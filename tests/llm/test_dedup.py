"""Jaccard join, paragraph dedup and suffix dedup against brute force."""

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from pagemill.llm import families, suffix_dedup, textops
from pagemill.llm import jaccard_join as joining
from pagemill.llm.jaccard_join import jaccard_join, keep_first, signatures, slack
from pagemill.llm.paragraph_dedup import drop_repeated_paragraphs, paragraph_clusters, tune_bands
from pagemill.llm.passages import repeated_passages
from pagemill.llm.queries import op9_paragraph_dedup
from pagemill.llm.suffix_dedup import cut, repeated_spans, suffix_order

LOW = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def word_list(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOW))


def shingle_set(words, k):
    return frozenset(tuple(words[j : j + k]) for j in range(max(1, len(words) - k + 1))) if words else frozenset()


def brute_components(sets, percent):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for x, i in enumerate(ids):
        for j in ids[:x]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("k, percent, small", [(3, 90, 24), (5, 80, 24), (3, 90, 3)])
def test_jaccard_join(docs, rows, monkeypatch, k, percent, small):
    monkeypatch.setattr(families, "SMALL", small)
    monkeypatch.setattr(families, "BLOCK", 8)
    sets = {r[0]: shingle_set(word_list(r[1]), k) for r in rows}
    want = brute_components(sets, percent)
    got = jaccard_join(docs, k, percent).collect()
    assert len(got) == len(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == {i: (len(s), want[i]) for i, s in sets.items()}


def test_jaccard_join_empty_and_null_id(spark, none):
    assert jaccard_join(none).count() == 0
    rows = jaccard_join(spark.createDataFrame([(None, "a b c d"), (4, "a b c d"), (4, "a b c d")], "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.component_id or 0) for r in rows) == [(0, 0), (4, 4), (4, 4)]


def test_keep_first(docs, rows):
    joined = jaccard_join(docs, 3, 90)
    kept = keep_first(docs, joined)
    first = {r.doc_id for r in joined.collect() if r.component_id == r.doc_id}
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in rows if r[0] in first)


@pytest.mark.parametrize("percent", [80, 90])
def test_linked_sets_share_a_signature(percent):
    rng = np.random.default_rng(3)
    for _ in range(400):
        n = int(rng.integers(2, 400))
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        lost = rng.integers(0, slack(len(x), percent) + 1)
        keep = np.sort(rng.choice(x, len(x) - lost, replace=False))
        more = int((len(keep) * 100 // percent - len(keep)) * rng.random())
        y = np.unique(np.concatenate([keep, rng.integers(0, 2**63, more, dtype=np.uint64)]))
        both = len(np.intersect1d(x, y))
        if 100 * both < percent * (len(x) + len(y) - both) or len(x) == len(y) == both:
            continue
        common = lambda t: t % np.uint64(100) < np.uint64(rng_share)  # noqa: B023, E731
        rng_share = int(rng.integers(0, 101))
        assert np.intersect1d(signatures(x, common(x), percent), signatures(y, common(y), percent)).size


@pytest.mark.parametrize("percent", [80, 90])
def test_sketches_lose_no_link(spark, percent):
    rng = np.random.default_rng(11)
    sets = []
    for n in [1, 2, 3, 9, 60, 64, 65, 100, 127, 128, 129, 300, 513, 700] * 3:
        x = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
        keep = x[rng.permutation(n)[: n - rng.integers(0, slack(n, percent) + 2)]]
        more = rng.integers(0, 2**63, rng.integers(0, slack(n, percent) + 2), dtype=np.uint64)
        sets += [x, np.unique(np.concatenate([keep, more]))]
    links = set(brute_links(sets, percent))
    assert len(links) > 10
    sketches = [families.sketch(x) for x in sets]
    marks = spark.createDataFrame([(i, len(x), s.tolist()) for i, (x, s) in enumerate(zip(sets, sketches))], "node long, n long, sketch array<long>")
    pairs = spark.createDataFrame([(i, j) for j in range(len(sets)) for i in range(j)], "a long, b long")
    left = {(r.a, r.b) for r in families.possible_pairs(pairs, marks, percent).collect()}
    assert links <= left and len(left) < 4 * len(sets)
    n, at = np.array([len(x) for x in sets]), np.arange(len(sets))
    words = pa.array([s.tolist() for s in sketches], pa.list_(pa.int64()))
    for own in (np.zeros(len(sets), int), at % 2):
        met = families._possible(own, at, n, words, percent)
        want = {x for p in links for x in p if len(set(own)) == 1 or own[p[0]] != own[p[1]]}
        assert want <= set(at[met]) and not met.all()
        assert not families._possible(own, at * 0, n, words, percent).any()


def brute_links(sets, percent):
    for j, y in enumerate(sets):
        for i, x in enumerate(sets[:j]):
            both = len(np.intersect1d(x, y))
            if 100 * both >= percent * (len(x) + len(y) - both):
                yield i, j


def test_tokens_are_made_for_possible_links_only(spark, monkeypatch):
    """Sets that share a passage and signatures, but can't reach the threshold, don't have their tokens moved."""
    r = np.random.default_rng(5)
    words = lambda n: " ".join(f"w{x}" for x in r.integers(0, 10**9, n))
    passage, near = words(30), words(60)
    texts = [f"{words(60)} {passage} {words(50)}" for _ in range(40)] + [near, f"{near} end"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    every, asked, made = np.full(joining.hash_filter(spark.range(1), "id").shape, 2**64 - 1, dtype=np.uint64), set(), joining._tokens_of
    monkeypatch.setattr(joining, "hash_filter", lambda *_: every)  # as full as over very many documents
    monkeypatch.setattr(joining, "_tokens_of", lambda d, needed, k: asked.update(x.doc_id for x in needed.collect()) or made(d, needed, k))
    got = {x.doc_id: x.component_id for x in jaccard_join(docs, 3, 90).collect()}
    assert got == {**{i: i for i in range(41)}, 41: 40}
    assert asked == {40, 41}


def test_copies_are_indexed_once(spark, monkeypatch):
    """Copies in many tasks give the signatures of one set, and don't make its tokens frequent."""
    r = np.random.default_rng(6)
    text, other = (" ".join(f"w{x}" for x in r.integers(0, 10**9, 102)) for _ in range(2))
    docs = spark.createDataFrame([(i, text) for i in range(12)] + [(None, other), (12, other)], "doc_id long, text string").repartition(7)
    given, made = [], joining._indexed
    monkeypatch.setattr(joining, "_indexed", lambda *args: given.append(made(*args)) or given[0])
    assert {x.doc_id: x.component_id for x in jaccard_join(docs, 3, 90).collect()} == {None: None, 12: 12, **dict.fromkeys(range(12), 0)}
    assert [x["count"] for x in given[0].groupBy("node").count().collect()] == [slack(100, 90) + 1] * 2


def brute_paragraphs(rows, k=5, percent=80, min_run=30):
    found = {}
    for r in {(r[0], r[1]) for r in rows if r[0] is not None}:
        para = 0
        for n, line in enumerate((r[1] or "").split("\n")):
            words = word_list(line)
            if len(words) >= k:
                found[(r[0], n)] = (para, words)
                para += 1
    keys = sorted(found)
    comp = brute_components({i: shingle_set(found[key][1], k) for i, key in enumerate(keys)}, percent)
    size = Counter(comp.values())
    runs = defaultdict(list)
    for i, key in enumerate(keys):
        if size[comp[i]] > 1:
            runs[key[0]].append((found[key][0], key, comp[i], len(found[key][1])))
    out = {}
    for marks in runs.values():
        marks.sort()
        groups, run = [], []
        for m in marks:
            if run and m[0] != run[-1][0] + 1:
                groups.append(run)
                run = []
            run.append(m)
        for run in [*groups, run]:
            if sum(m[3] for m in run) >= min_run:
                out.update({m[1]: m[2] != keys.index(m[1]) for m in run})
    return out


def test_paragraph_clusters(docs, rows):
    got = paragraph_clusters(docs).collect()
    assert {(r.doc_id, r.line): r.removed for r in got} == brute_paragraphs(rows)
    assert len({(r.doc_id, r.line) for r in got}) == len(got)
    assert {r.doc_id for r in got} >= set(range(100, 112))


def test_paragraphs_dropped(docs, rows, none):
    clusters = paragraph_clusters(docs)
    left = drop_repeated_paragraphs(docs, clusters)
    gone = {k for k, removed in brute_paragraphs(rows).items() if removed}
    want = Counter(
        (r[0], None if r[1] is None else "\n".join(x for n, x in enumerate(r[1].split("\n")) if (r[0], n) not in gone)) for r in rows
    )
    assert left.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in left.collect()) == want
    assert paragraph_clusters(none).count() == 0


def brute_passages(rows, size):
    """Words of every document that stand in a window which an earlier place has too."""
    texts = sorted({(r[0], r[1] or "") for r in rows if r[0] is not None})
    first, out = {}, {}
    for i, text in texts:
        words = word_list(text)
        out[i] = set()
        for j in range(len(words) - size + 1):
            if first.setdefault(tuple(words[j : j + size]), (i, j)) != (i, j):
                out[i] |= set(range(j, j + size))
    return out


@pytest.mark.parametrize("size", [30, 51, 4])
def test_repeated_passages(spark, docs, rows, none, size):
    words = [f"w{i}" for i in range(400)]
    inside = " ".join(["x"] * 9 + words[20:90] + ["y"] * 7)  # begins and ends inside a line
    short = "\n".join(" ".join(words[i : i + 3]) for i in range(100, 190, 3))  # lines of three words
    planted = [(1000, " ".join(words)), (1001, inside), (1002, short), (1003, "a b\n" * 40), (1004, f"{inside}\n{inside} end")]
    more = docs.select("doc_id", "text").union(spark.createDataFrame(planted, "doc_id long, text string"))
    got, runs = defaultdict(set), set()
    for r in repeated_passages(more, size).collect():
        stretch = set(range(r.first_word, r.first_word + r.n_words))
        assert not got[r.doc_id] & stretch and r.n_words >= size and r.first_doc_id <= r.doc_id
        got[r.doc_id] |= stretch
        runs.add((r.doc_id, r.first_word, r.first_doc_id))
    want = brute_passages([*rows, *planted], size)
    assert {i: got[i] for i in want} == want
    if size > 4:
        assert (1001, 9, 1000) in runs and (1002, 0, 1000) in runs
    assert repeated_passages(none, size).count() == 0


def test_passages_of_texts_that_share_an_id(spark):
    one = " ".join(f"w{i}" for i in range(40))
    twice = spark.createDataFrame([(5, f"{one} a"), (5, f"b {one}"), (5, f"b {one}"), (None, one)], "doc_id long, text string").repartition(3)
    assert [(r.doc_id, r.n_words) for r in repeated_passages(twice).collect()] == [(5, 40)]


def test_op9_holds_passages_inside_lines(spark, tmp_path):
    words = [f"w{i}" for i in range(300)]
    own = [f"x{i}" for i in range(100)]
    rows = [(1, " ".join(words)), (2, " ".join(own[:50] + words[30:90] + own[50:])), (3, "\n".join(" ".join(words[i : i + 4]) for i in range(200, 260, 4)))]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = {(r.doc_id, r.first_word, r.n_words, r.first_doc_id) for r in op9_paragraph_dedup(spark, str(tmp_path)).collect() if r.removed}
    assert got >= {(2, 50, 60, 1), (3, 0, 60, 1)}


def test_bands_reach_recall():
    for percent in (60, 80, 90):
        bands, rows = tune_bands(percent, 0.99)
        assert 1 - (1 - (percent / 100) ** rows) ** bands >= 0.99


def brute_spans(rows, size, keep):
    texts = sorted({(r[0], (r[1] or "").encode()) for r in rows})
    places = defaultdict(list)
    for i, t in texts:
        for j in range(len(t) - size + 1):
            places[t[j : j + size]].append((i, j))
    out = {}
    for i, t in texts:
        hit = np.zeros(len(t) + 1, dtype=int)
        for j in range(len(t) - size + 1):
            at = places[t[j : j + size]]
            if len(at) > 1 and (keep == "none" or min(at) < (i, j)):
                hit[j] += 1
                hit[j + size] -= 1
        inside = np.concatenate([[0], (np.cumsum(hit)[: len(t)] > 0).astype(int), [0]])
        edges = np.flatnonzero(np.diff(inside))
        out[i] = [(int(a), int(b)) for a, b in zip(edges[::2], edges[1::2])]
    return out


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("hot", [2000, 1])
def test_repeated_spans(docs, rows, monkeypatch, keep, hot):
    monkeypatch.setattr(suffix_dedup, "HOT", hot)
    once = docs.dropDuplicates(["doc_id"])  # a repeated row would be a second place
    got = {r.doc_id: [(s.first, s.stop) for s in r.spans] for r in repeated_spans(once, 60, keep, 20).collect()}
    assert got == brute_spans(rows, 60, keep)


def test_cut(docs, rows, none):
    once = docs.dropDuplicates(["doc_id"])
    spans = repeated_spans(once, 60, "first", 20)
    kept = {bytes(r.digest): bytes(r.kept) for r in cut(once, spans).collect()}
    text = {r[0]: (r[1] or "").encode() for r in rows}
    for r in spans.collect():
        ends = [0, *(x for s in r.spans for x in s), r.n_bytes]
        left = b"".join(text[r.doc_id][a:b] for a, b in zip(ends[::2], ends[1::2]))
        if r.spans and left:
            assert kept[bytes(r.digest)] == left
        elif r.spans:  # all of a later copy goes; its text is cut where it first stands
            assert [(s.first, s.stop) for s in r.spans] == [(0, r.n_bytes)]
    assert repeated_spans(none).count() == 0


def test_repeated_rows_are_copies(spark):
    rows = spark.createDataFrame([(1, "ab" * 300), (1, "ab" * 300), (2, None), (3, "z" * 399), (4, "z" * 399)], "doc_id long, text string")
    got = sorted((r.doc_id, len(r.spans)) for r in repeated_spans(rows, 400, "none").collect())
    assert got == [(1, 1), (1, 1), (2, 0), (3, 0), (4, 0)]


def test_suffix_order():
    rng = np.random.default_rng(5)
    raw = [bytes(rng.integers(97, 99, 40, dtype=np.uint8)) for _ in range(60)]
    reach = rng.integers(0, 20, len(raw))
    key = rng.integers(0, 3, len(raw))
    text, base = np.frombuffer(b"".join(raw), dtype=np.uint8), 40 * np.arange(len(raw))
    for d, order in suffix_order(key, [r[p:] for r, p in zip(raw, reach)], text, base + reach, reach):
        want = sorted((int(key[i]), raw[i][reach[i] - d :], i) for i in range(len(raw)) if reach[i] >= d)
        assert [(int(key[i]), raw[i][reach[i] - d :]) for i in order] == [w[:2] for w in want]


def test_long_chunks_make_their_powers_once(monkeypatch):
    """The tables of powers of texts beyond a step aren't kept, so they must not be made for each byte of depth."""
    monkeypatch.setattr(textops, "STEP_BYTES", 64)
    monkeypatch.setattr(textops, "_powers", {})
    made, accumulated = textops.powers, []
    monkeypatch.setattr(textops, "powers", lambda base, n: accumulated.append(n) or made(base, n))
    rng = np.random.default_rng(5)
    raw = rng.integers(97, 100, 600, dtype=np.uint8).tobytes()
    found = list(suffix_dedup._factors([(1, 0, b"x", 0, 201, 200, raw), (1, 1, b"y", 0, 201, 200, raw)], 400))
    assert sorted(found) == [(b"x", 0, 200, 0), (b"y", 0, 200, 1)]
    assert len(accumulated) <= 2


def test_hot_anchor_joins_stretches_not_strings(spark):
    text = np.random.default_rng(7).integers(97, 123, 1000, dtype=np.uint8).tobytes().decode()
    docs = spark.createDataFrame([(i, f"{text} {i}") for i in range(6)], "doc_id long, text string")
    every = np.full(suffix_dedup.hash_filter(spark.range(1), "id").shape, 2**64 - 1, dtype=np.uint64)
    shipped = suffix_dedup._shipped(docs, every, every, 400, 200).collect()
    strings = 6 * (1002 - 400 + 1)
    assert sum(r.n for r in shipped) == strings and all(len(r.ones) == len(r.twos) == r.n for r in shipped)
    assert len(shipped) < strings / 10


def test_blocks_are_compared_side_against_side():
    """Links between two blocks only, and none within a part; the blocks are not multiplied with themselves."""
    sets = [[1, 2, 3, 4], [1, 2, 3, 4, 5], [1, 2, 3, 4], [7, 8, 9, 10], [7, 8, 9, 10]]
    tokens = pa.array(sets, pa.list_(pa.int64()))
    own, node, part = np.array([0, 0, 1, 1, 1]), np.arange(5), np.arange(5)
    assert families._joining(own, node, part, tokens, 80) == [(0, 2), (1, 2)]
    assert families._joining(np.zeros(5, int), node, part, tokens, 80) == [(0, 1), (0, 2), (3, 4)]
    assert families._joining(own, node, np.array([0, 0, 0, 3, 4]), tokens, 80) == []
