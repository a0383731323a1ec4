"""Alignment, language identification and phrases against brute force."""

from __future__ import annotations

import random
import zlib
from collections import Counter

import numpy as np
import pytest

from forgepulse.llm import alignment, collocations, language
from forgepulse.llm.perfect_hash import Segment, dense_counts, hash_table
from tests.llm.fixtures import SCHEMA, awkward, prose, table


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    from forgepulse.llm.common import ship

    ship(spark)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# -- perfect hash ------------------------------------------------------------------------


@pytest.mark.parametrize("n", [0, 1, 2, 5000])
def test_slots_are_minimal_and_perfect(n):
    rng = np.random.default_rng(n)
    keys = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
    segment = Segment.of(keys, keys[:, None] + 1)
    slots = segment.find(keys)
    assert sorted(slots) == list(range(len(keys)))
    assert (segment.columns[slots, 0] == keys + 1).all()
    assert (segment.find(keys + 1)[~np.isin(keys + 1, keys)] == -1).all()


def test_dense_counts_equal_sums(spark):
    rng = random.Random(5)
    rows = [(rng.randrange(400) << 32 | rng.randrange(9), rng.randrange(1, 5)) for _ in range(5000)]
    rows += [(7, 1)] * 3000  # a hot key
    partials = spark.createDataFrame(rows, "key bigint, n bigint").repartition(7)
    counts = Counter()
    for key, n in rows:
        counts[key] += n
    found = dense_counts(partials, hash_table(partials.select("key").distinct(), segment_keys=300))
    assert len(found.files) > 5
    keys = np.array([*counts, -1, 1 << 50], np.int64)
    slots, values = found.look_up(keys)
    assert values[:, 0].tolist() == [*counts.values(), 0, 0]
    assert sorted(slots[:-2]) == list(range(len(counts))) and (slots[-2:] == -1).all()


# -- alignment ---------------------------------------------------------------------------

TRICKY = [
    " leading", "trailing ", "two  spaces   three", "tab\t x\n y \n\n z", "a b   c", "▁ mark",
    "<|endoftext|> and <s> </s> <unk> <0x0A>", "\U0001f600 emoji‍♂ 日本語の文", "it's we'll", " ", "\x00\x1c \x85 x", "x" * 3000,
]


def brute_alignment(rows):
    units = alignment.Aligner(*alignment.vocabularies())
    cuts, counts = [], Counter()
    for _, text in rows:
        if not text:
            cuts.append(None)
            continue
        a = units.a.encode(" " + text, add_special_tokens=False).ids
        b = units.b.encode(text)
        a_bytes, b_bytes = [units.a_bytes[i] for i in a], [units.b_bytes[i] for i in b]
        if not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            cuts.append(None)
            continue
        a_ends, b_ends = (np.cumsum([len(x) for x in side]).tolist() for side in (a_bytes, b_bytes))
        links, j = [], 0
        for i, end in enumerate(a_ends):
            start = end - len(a_bytes[i])
            while b_ends[j] <= start:
                j += 1
            k = j
            while k < len(b) and b_ends[k] - len(b_bytes[k]) < end:
                links.append((a[i], b[k]))
                k += 1
        groups, i, j = [], 0, 0
        a_place, b_place = ({end: k + 1 for k, end in enumerate(ends)} for ends in (a_ends, b_ends))
        for end in sorted(a_place.keys() & b_place.keys()):
            to_i, to_j = a_place[end], b_place[end]
            groups.append(",".join(map(str, a[i:to_i])) + "|" + ",".join(map(str, b[j:to_j])))
            i, j = to_i, to_j
        counts.update(links)
        cuts.append((len(a), len(b), groups, links))
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = []
    for (doc_id, _), cut in zip(rows, cuts, strict=True):
        if cut is None:
            out.append((doc_id, 0, 0, 0, 0, 0, 0, ""))
            continue
        n_a, n_b, groups, links = cut
        n_best = sum(counts[p] == best[p[1]] for p in links)
        out.append((doc_id, n_a, n_b, len(groups), len(links), n_best, sum(counts[p] for p in links), ";".join(groups)))
    return sorted(out, key=repr)


def test_alignment_equals_brute_force(spark):
    docs = awkward() + [(100 + k, t, "en", "s", len(t)) for k, t in enumerate(TRICKY)]
    found = alignment.align_documents(table(spark, docs, clashes=True).repartition(3))
    assert rows_of(found) == brute_alignment([row[:2] for row in docs])
    # Bytes that no piece gives back: this mark is read as a space.
    assert found.where("doc_id = 105").first().n_a == 0


def test_alignment_of_an_empty_table(spark):
    assert alignment.align_documents(spark.createDataFrame([], SCHEMA)).isEmpty()
    assert rows_of(alignment.align_documents(table(spark, [(1, None, "en", "s", 0)]))) == [(1, 0, 0, 0, 0, 0, 0, "")]


# -- languages ---------------------------------------------------------------------------


def test_language_counts_and_backoff(spark):
    docs = [(k, t, lang, "s", 0) for k, (t, lang) in enumerate(
        [("the house and the garden", "en"), ("das haus und der garten", "de")] * 20
    )]
    learned_from = [d for d in docs if zlib.crc32(str(d[0]).encode()) % 4 != 2]
    extra = [
        (900, "the the garden", None, "s", 0), (901, "GARTEN! und", "en", "s", 0), (902, None, "en", "s", 0),
        (903, "123 ... ½", "de", "s", 0), (904, "gartens gartenhaus", None, "s", 0),
        (905, "中文", None, "s", 0), (None, "the", "de", "s", 0), (907, "", "", "s", 0),
    ]
    found = {r.doc_id: r for r in language.identify_languages(table(spark, docs + extra, clashes=True)).collect()}
    assert len(found) == len(docs) + len(extra)
    for doc_id, row in found.items():
        assert 0 <= row.score <= 1
        assert row.held_out == (doc_id is not None and zlib.crc32(str(doc_id).encode()) % 4 == 2)
    assert all(found[d[0]].lang_pred == d[2] for d in docs)
    assert [found[k].lang_pred for k in (900, 902, 903, 904, 907)] == ["en", "und", "und", "de", "und"]
    assert found[905].lang_pred in ("en", "de") and found[None].lang_pred == "en"
    assert found[902].score == found[907].score == 0

    # The score of a text of known words, by hand.
    counts = {lang: Counter(w for d in learned_from + extra[1:2] * (zlib.crc32(b"901") % 4 != 2) if d[2] == lang
                            for w in language.words_of(d[1])) for lang in ("de", "en")}
    logs = [
        sum(np.log((c[w] + 0.1) / (c.total() + 0.1)) for w in ("the", "the", "garden")) / 3
        for c in (counts["de"], counts["en"])
    ]
    assert found[900].score == pytest.approx(np.exp(logs[1]) / np.exp(logs).sum())


def test_nothing_to_learn_from(spark):
    docs = [(1, "word", None, "s", 0), (2, None, "en", "s", 0), (None, "word", "en", "s", 0)]
    assert {tuple(r)[2:] for r in language.identify_languages(table(spark, docs)).collect()} == {("und", 0.0)}
    assert language.identify_languages(spark.createDataFrame([], SCHEMA)).isEmpty()


# -- phrases -----------------------------------------------------------------------------


def brute_phrases(docs, longest, least, shown):
    counts, sizes = {}, Counter()
    for _, text, lang, *_ in docs:
        lang, pieces = lang or "und", [[]]
        for token in collocations.tokens(text):
            if token == b"\xff":
                pieces.append([])
            else:
                pieces[-1].append(token.decode())
        f = counts.setdefault(lang, Counter())
        for piece in pieces:
            sizes[lang] += len(piece)
            for k in range(1, longest + 1):
                f.update(tuple(piece[i : i + k]) for i in range(len(piece) - k + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inside = {
            p[i : i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
            if a >= f[p[i : i + k]]
        }
        rows = []
        for p, a in candidates.items():
            if p in inside:
                continue
            cuts = [(1000 * a * sizes[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p))]
            score, k = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        out += [
            (lang, rank, phrase.decode(), -a, l, r, sizes[lang], -score)
            for rank, (score, a, phrase, l, r) in enumerate(sorted(rows)[:shown], start=1)
        ]
    return sorted(out, key=repr)


@pytest.mark.parametrize("shown", [2000, 4])
def test_phrases_equal_brute_force(spark, shown, monkeypatch):
    rng = random.Random(9)
    words = ["New", "york", "city", "of", "the", "a", "été", "b"]
    texts = [" ".join(rng.choices(words, k=rng.randint(0, 60))).replace(" a ", rng.choice([". ", " a ", "\t", "\n"])) for _ in range(60)]
    docs = awkward() + [(k, t, rng.choice(["en", None, "und"]), "s", 0) for k, t in enumerate(texts)]
    found = collocations.mine_phrases(table(spark, docs, clashes=True).repartition(3), least=8, shown=shown)
    assert rows_of(found) == brute_phrases(docs, 5, 8, shown)


def test_no_phrases(spark):
    assert collocations.mine_phrases(spark.createDataFrame([], SCHEMA)).isEmpty()
    assert collocations.mine_phrases(table(spark, [(1, prose(3, 50), "en", "s", 0)])).isEmpty()


def test_the_trie_bursts_and_spills_whole_subtrees(monkeypatch):
    monkeypatch.setattr(collocations, "BURST", 50)
    rng, trie, counts, runs = np.random.default_rng(1), collocations.Trie(3), Counter(), {}

    def take(left):
        for subtree, keys, n in trie.spilled(left):
            assert (np.diff(keys) > 0).all() and subtree not in trie.nodes
            keys, n = collocations.from_run(collocations.to_run(keys, n))
            runs.setdefault(subtree, []).append((keys, n))

    for _ in range(20):
        # Half of the keys share one prefix.
        prefix = np.where(rng.random(500) < 0.5, 4, rng.integers(0, 300, 500))
        keys = prefix << collocations.PLACE | rng.integers(0, 400, 500)
        counts.update(keys.tolist())
        trie.add(keys)
        if trie.size > 1500:
            assert any(isinstance(node, list) for node in trie.nodes.values())
            take(700)
            assert trie.size <= 700
    take(0)
    found = Counter()
    for parts in runs.values():
        keys, n = collocations.merged_runs([k for k, _ in parts], [n for _, n in parts])
        found.update(dict(zip(keys.tolist(), n.tolist(), strict=True)))
    assert found == counts and len(runs) == 3
