"""What workers remember between texts: units and n-grams, each worked out once."""

from __future__ import annotations

import gc
from collections import Counter

import numpy as np
import pytest

from forgepulse.llm import alignment, language
from forgepulse.llm.common import uncollected
from forgepulse.llm.perfect_hash import Segment

ODD = ["", "a", " b", "end\n", "\t", "\ta", "▁", "a▁", "é", "日本", "<s>", "<|endoftext|>", "½", "😀", "word"]


@pytest.fixture(scope="module")
def units():
    return alignment.Aligner(*alignment.vocabularies())


def test_joined_units_have_the_tokens_of_single_ones(units):
    many = ODD + [f"word{k}" for k in range(2 * alignment.JOINED)]
    wholes = [(" " + u).encode() for u in many]
    single = [units.a.encode(" " + u, add_special_tokens=False).ids for u in many]
    assert units.a_tokens(many, wholes) == single


def test_units_are_checked_byte_by_byte(units):
    wholes = [(" " + u).encode() for u in ODD]
    a_ids = [units.a.encode(" " + u, add_special_tokens=False).ids for u in ODD]
    b_ids = [ids or [units.space] for ids in units.b.encode(ODD)]
    # One token too few, and another one of the same length.
    a_ids[8], other = a_ids[8][:-1], units.a.encode(" worm", add_special_tokens=False).ids
    a_ids[14] = other
    back = [
        b"".join(units.a_bytes[i] for i in a) == whole == b"".join(units.b_bytes[i] for i in b)
        for whole, a, b in zip(wholes, a_ids, b_ids, strict=True)
    ]
    assert not back[8] and not back[14] and not back[6] and back[1]
    assert units.faithful(wholes, a_ids, b_ids).tolist() == back


def test_frequent_units_are_not_aligned_again(units, monkeypatch):
    monkeypatch.setattr(alignment, "MOST_UNITS", 4)
    units.forget()
    rare = [f"rare{k}" for k in range(10)]
    (before, _) = units.places([["often", "seldom", "often", "seldom", "often"], rare], None)
    kept = units.figures[before[0]].tolist()
    pairs = np.sort(units.pairs[units.pairs_of == before[0]]).tolist()
    assert units.full
    units.thin()
    assert list(units.known) == ["often", "seldom"]
    learned = []
    monkeypatch.setattr(units, "learn", lambda new, table: learned.extend(new))
    ((after,),) = units.places([["often"]], None)
    assert not learned
    assert units.figures[after].tolist() == kept
    assert np.sort(units.pairs[units.pairs_of == after]).tolist() == pairs


def test_n_grams_of_all_words_are_hashed_once(spark, monkeypatch):
    rows = [("en", "abab", 3), ("en", "ab", 1), ("fr", "ab", 1), ("en", "é", 3), ("en", "cab", 3)]
    wanted: Counter = Counter()
    for lang, word, n in rows:
        wanted[lang, 0, language.key_of(0, word)] += n
        for length in range(1, language.LONGEST + 1):
            for gram in language.grams_of(word, length):
                wanted[lang, length, language.key_of(length, gram)] += n
    words = spark.createDataFrame(rows, "lang string, word string, n bigint")
    found = language.feature_counts(words).collect()
    assert {(r.lang, r.length, r.key): r.n for r in found} == wanted and len(found) == len(wanted)

    hashed = []
    monkeypatch.setattr(language, "key_of", lambda length, gram: hashed.append((length, gram)) or 0)
    seen = {"en": Counter()}
    language.add_times(seen["en"], Counter(language.all_grams("abab")), 3)
    language.add_times(seen["en"], Counter(language.all_grams("ab")), 1)
    assert len(language.hashed(seen)) == len(hashed) == len(set(hashed))
    assert seen["en"]["ab"] == 7 and seen["en"][" "] == 8


def test_collections_go_on_after_an_error():
    with pytest.raises(ValueError), uncollected():
        assert not gc.isenabled()
        raise ValueError
    assert gc.isenabled()


@pytest.mark.parametrize("most", [7, 2**31 - 1, 2**31, 2**40])
def test_segments_keep_counts_of_any_size_in_as_few_bytes_as_they_need(tmp_path, most):
    keys = np.arange(-500, 500, dtype=np.int64) * 7919
    values = np.stack([np.arange(1000), np.full(1000, most)], axis=1)
    path = str(tmp_path / "segment")
    Segment.of(keys, values).write(path)
    back = Segment.read(path)
    slots = back.find(keys)
    assert sorted(slots) == list(range(1000))
    assert (back.columns[slots] == values).all()
    assert back.find(keys + 1).max() == -1
    assert back.columns.itemsize == (4 if most < 2**31 else 8) and back.rank.itemsize == 2
