"""Whitening, the prefix trie and language-model scores against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from barloom.llm import kneser_ney, prefix_trie, whitening
from barloom.llm.queries import QUERIES

from .conftest import TEXTS

SF_DIR = "/root/testdata/sf0.001"

# Whitening -----------------------------------------------------------------------


def test_whitening_query(spark):
    vectors = {r.vec_id: r.embedding for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").collect()}
    ids = list(vectors)
    x = np.floor(1024 * np.array([vectors[i] for i in ids])).astype(int) + 100000
    n, sums = len(x), x.sum(axis=0)
    exact = {i: sum((n * int(v) - int(s)) ** 2 for v, s in zip(row, sums)) for i, row in zip(ids, x)}
    centred = x - sums / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1], axes[:, ::-1]
    white = dict(zip(ids, centred @ axes / np.sqrt(values)))
    rows = QUERIES["op11_whitening"](spark, SF_DIR).collect()
    assert len(rows) == 8 * n and {r.component for r in rows} == set(range(1, 9))
    signs = defaultdict(set)
    for r in rows:
        assert (r.n, r.deviation) == (n, exact[r.vec_id])
        expected = white[r.vec_id][r.component - 1]
        assert abs(abs(r.whitened) - abs(expected)) < 1e-9
        signs[r.component].add(np.sign(r.whitened) == np.sign(expected))
        assert r.explained == pytest.approx(values[r.component - 1] / values.sum(), rel=1e-9)
        assert r.identity_error < 1e-9
    assert all(len(s) == 1 for s in signs.values())


def whitened(spark, rows, kind="array<double>"):
    df = spark.createDataFrame([(*r, 1, "n") for r in rows], f"vec_id bigint, embedding {kind}, n int, dim string")
    return whitening.by_component(whitening.whiten(df)).collect()


def test_whitening_leaves_out_what_is_not_finite(spark):
    odd = [(2, None), (3, [None, 1.0]), (4, [float("nan"), 1.0]), (5, [float("-inf"), 1.0]), (6, [1.0]), (7, [])]
    rows = whitened(spark, [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [3.0, 7.0]), *odd], "array<float>")
    assert Counter(r.vec_id for r in rows) == {1: 4, None: 2}
    # All values lie on one line: the second component varies nowhere.
    assert [r.whitened is None for r in rows] == [r.component == 2 for r in rows]
    assert {r.n for r in rows} == {3} and all(r.identity_error < 1e-9 for r in rows)


def test_whitening_of_constants_and_nothing(spark):
    rows = whitened(spark, [(1, [1.0, 2.0])] * 3)
    assert {(r.deviation, r.whitened, r.explained, r.identity_error) for r in rows} == {(0, None, None, None)}
    assert whitened(spark, []) == []
    assert whitened(spark, [(1, []), (2, None)]) == []


def test_whitening_of_huge_entries_is_exact(spark):
    x = [[2.0**40, 5.0, -3.0], [-(2.0**40), 1e13, 2.0], [1.0, 2.0, 1e15], [3.0, -(2.0**38), 8.0], [0.0, 1.0, 2.0]]
    df = spark.createDataFrame(list(enumerate(x)), "vec_id bigint, embedding array<double>")
    found = whitening.whiten(df)
    whole = [[math.floor(1024 * c) + 100000 for c in row] for row in x]
    sums = [sum(c) for c in zip(*whole)]
    for r in found.collect():
        assert r.deviation == sum((5 * c - s) ** 2 for c, s in zip(whole[r.vec_id], sums))
    # Beyond 62 bits values stand still, digits beyond 38 are null.
    rows = whitened(spark, [(1, [1e300, 1.0]), (2, [-1e300, 2.0]), (3, [0.0, 3.0])])
    assert len(rows) == 6
    assert {r.vec_id for r in rows if r.deviation is None} == {1, 2}


# Prefix trie ---------------------------------------------------------------------

NODE = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute_trie(rows):
    def key(c):
        return (c is None, c or 0)

    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append(((turn is not None, turn or 0), role or "", text or ""))
    convs = {c: [t[1:] for t in sorted(v)] for c, v in convs.items()}
    whole = {}
    for c, turns in convs.items():
        h = 0 if c is None else zlib.crc32(str(c).encode()) % 6
        base = [] if c is None else convs.get(c - int(math.fmod(c, 100)), [])
        whole[c] = tuple(base[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = Counter(s[:-1] for s in members if s)
    leaves, saved = Counter(), Counter()
    for s, m in members.items():
        for d in range(len(s) + 1):
            leaves[s[:d]] += not children[s]
            saved[s[:d]] += (len(m) - 1) * len(s[-1][1]) if s else 0
    out = Counter()
    for s, m in members.items():
        ends = ",".join("" if c is None else str(c) for c in sorted((c for c in m if whole[c] == s), key=key))
        parent = min(members[s[:-1]], key=key) if s else None
        out[min(m, key=key), len(s), parent, len(m), children[s], leaves[s], saved[s], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def test_trie_query(spark):
    rows = spark.read.parquet(f"{SF_DIR}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    found = Counter(tuple(r) for r in QUERIES["op12_prefix_trie"](spark, SF_DIR).select(*NODE).collect())
    assert found == brute_trie([tuple(r) for r in rows])


@pytest.fixture
def odd_turns():
    """Few texts, so that much is shared; null turns, roles, texts and ids; ties; ids below zero; a long text."""
    rng = random.Random(1)
    rows = []
    for c in [*range(40), *range(100, 130), None, -3, -100, -150, 300, 300]:
        for t in range(rng.randint(1, 7)):
            rows.append((c, rng.choice([t, t, None]), rng.choice(["u", None, ""]), rng.choice(["a", "bé", "", "x" * 100_000, None])))
    return rows


def test_trie_of_odd_turns(spark, odd_turns, monkeypatch):
    names = "conv_id bigint, turn bigint, role string, text string, depth string, f1 int, place int, n int"
    df = spark.createDataFrame([(*r, "d", 1, 2, 3) for r in odd_turns], names).repartition(5)
    monkeypatch.setattr(prefix_trie, "HOT_CHILDREN", 2)
    nodes, ends = prefix_trie.prefix_trie(df)
    nodes = nodes.collect()
    assert Counter(tuple(r[c] for c in NODE) for r in nodes) == brute_trie(odd_turns)
    assert {(r.depth == 0, r.text is None) for r in nodes} == {(True, True), (False, False)}
    assert ends.count() == len({r[0] for r in odd_turns})


def test_trie_of_nothing(spark):
    df = spark.createDataFrame([], "conv_id bigint, turn bigint, role string, text string")
    assert [f.count() for f in prefix_trie.prefix_trie(df)] == [0, 0]


def test_trie_as_it_is(spark):
    rows = [(i, 0, "u", "hello") for i in range(1, 6)] + [(5, 1, "a", "more")]
    df = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    nodes, ends = prefix_trie.prefix_trie(df, rebuild=False)
    found = {(r.depth, r.conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.text) for r in nodes.collect()}
    assert found == {(0, 1, 5, 1, 1, 20, None), (1, 1, 5, 1, 1, 20, "hello"), (2, 5, 1, 0, 1, 0, "more")}
    assert ends.where("depth = 1").count() == 4


# Language-model scores -----------------------------------------------------------


def tokens(text):
    lower = re.sub("[A-Z]+", lambda m: m[0].lower(), text or "")
    return [f"w{w}" for w in re.findall(r"[^\x20\x09-\x0D]+", lower)] + ["end"]


class BruteModel:
    def __init__(self, texts):
        self.pairs = Counter(p for t in texts for w in [["begin", *tokens(t)]] for p in zip(w, w[1:]))
        self.words, self.before, self.total, self.followers = Counter(), Counter(), Counter(), defaultdict(Counter)
        for (h, w), c in self.pairs.items():
            self.words[w] += c
            self.before[w] += 1
            self.total[h] += c
            self.followers[h][min(c, 3)] += 1
        self.pair_d, self.word_d = (self.discounts(c) for c in (self.pairs, self.before))
        kinds = Counter(min(c, 3) for c in self.before.values())
        self.rest = sum(self.word_d[k] * kinds[k] for k in (1, 2, 3)) / len(self.pairs) if self.pairs else 1

    @staticmethod
    def discounts(counts):
        n = Counter(counts.values())
        return (0, *kneser_ney.discounts([n[k] for k in (1, 2, 3, 4)]))

    def alone(self, w):
        c = self.before[w]
        return max(c - self.word_d[min(c, 3)], 0) / max(len(self.pairs), 1) + self.rest / (len(self.words) + 1)

    def probability(self, h, w):
        if not self.total[h]:
            return self.alone(w)
        c, d, total = self.pairs[h, w], self.pair_d, self.total[h]
        return max(c - d[min(c, 3)], 0) / total + sum(d[k] * self.followers[h][k] for k in (1, 2, 3)) / total * self.alone(w)

    def score(self, text):
        found, n, v = tokens(text), sum(self.words.values()), len(self.words)
        base = sum(math.log10((self.words[w] + 0.1) / (n + 0.1 * (v + 1))) for w in found)
        model = sum(math.log10(self.probability(*p)) for p in zip(["begin", *found], found))
        return len(found), sum(self.words[w] > 0 for w in found), n, base, model


def held_out(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def same_scores(found, rows):
    model = BruteModel([t for i, t in rows if not held_out(i)])
    expected = sorted((i is None, i or 0, held_out(i), *model.score(t)) for i, t in rows)
    got = sorted((r.doc_id is None, r.doc_id or 0, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in found)
    assert [g[:6] for g in got] == [e[:6] for e in expected]
    for g, e in zip(got, expected):
        assert g[6:] == pytest.approx(e[6:], rel=1e-9, abs=1e-9)
    return model


def test_language_model_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()]
    found = QUERIES["op13_kneser_ney"](spark, SF_DIR).collect()
    model = same_scores(found, rows)
    # Probabilities of all known tokens and the unknown one add up to one, for known and unknown contexts.
    for context in ("begin", *list(model.words)[:5], "nowhere"):
        assert sum(model.probability(context, w) for w in [*model.words, "nowhere"]) == pytest.approx(1)
    unseen = [r for r in found if r.held_out]
    assert unseen and sum(r.score for r in unseen) > sum(r.base_score for r in unseen)


@pytest.mark.parametrize("size", [1, 24_000_000])
def test_language_model_of_odd_texts(spark, documents, size):
    found = kneser_ney.cross_scored(documents, slice_bytes=size, shard_bytes=1 if size == 1 else size).collect()
    same_scores(found, TEXTS)


def test_language_model_without_training(documents, no_documents):
    assert kneser_ney.cross_scored(no_documents).count() == 0
    model = kneser_ney.train(no_documents)
    assert {r.score for r in kneser_ney.scored(documents, model).collect()} == {0.0}
